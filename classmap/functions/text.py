"""Text rules as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from classmap.functions.names import col

# The characters a Unicode-aware strip removes, and line breaks.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
LINE_BREAKS = "[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]+"
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
NUMBER = r"(?U)\d+(?:\.\d+)?"
DIGIT = r"(?U)\d"

# Limits of an acceptable main name and of its fallback.
MAX_NAME_CHARS = 60
MAX_NAME_WORDS = 8
FALLBACK_TOKENS = 3
NAME_SEPARATORS = r"(?U)[\s\x1c-\x1f,;/]+"

# Numbers followed by a length unit, alone or as an "a x b x c" product.
DIMENSION = (
    r"(?i)(\d+(?:\.\d+)?(?:\s*(?:MM|CM|KM|M)?\s*X\s*\d+(?:\.\d+)?)*)"
    r"\s*(MM|CM|KM|M(?![A-Za-z]))"
)


def strip(c, chars: str = WHITESPACE) -> Column:
    return F.btrim(col(c), F.lit(chars))


def nonblank(c) -> Column:
    """True when the text is not null and not only whitespace."""
    return F.coalesce(strip(c) != "", F.lit(False))


def words(c) -> Column:
    return F.filter(F.split(col(c), SPACE_RUN), lambda w: w != "")


def text_of(c, dtype: str) -> Column:
    """Text form of a value; whole-number doubles read as integers."""
    c = col(c)
    if dtype in ("float", "double"):
        whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
        return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def join_key(c, dtype: str) -> Column:
    """Key text: null stays null, no trimming, no case change."""
    return text_of(c, dtype)


def replace_missing_text(c) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def pick_first_nonblank(*cols) -> Column:
    texts = [F.nullif(strip(c), F.lit("")) for c in cols]
    return F.coalesce(*texts, F.lit(""))


def clean_single_line(c) -> Column:
    t = strip(F.coalesce(col(c), F.lit("")))
    t = strip(strip(t, "`"))
    t = strip(strip(strip(t, '"'), "'"))
    lines = F.filter(F.transform(F.split(t, LINE_BREAKS), lambda x: strip(x)), lambda x: x != "")
    return F.coalesce(F.get(lines, F.lit(0)), F.lit(""))


def numbers_preserved(original, result) -> Column:
    """Every number of the original also occurs in the result."""
    found = F.regexp_extract_all(col(original), F.lit(NUMBER), F.lit(0))
    return F.forall(found, lambda n: F.contains(col(result), n))


def is_valid_main_name(c) -> Column:
    c = F.coalesce(col(c), F.lit(""))
    return (
        (c != "")
        & ~c.rlike(DIGIT)
        & (F.length(c) <= MAX_NAME_CHARS)
        & (F.size(words(c)) <= MAX_NAME_WORDS)
    )


def fallback_main_name(c) -> Column:
    """The first few tokens that hold no digit, or the whole text if there is none."""
    text = strip(F.coalesce(col(c), F.lit("")))
    tokens = F.filter(
        F.split(text, NAME_SEPARATORS), lambda w: ~w.rlike(DIGIT) & (F.length(w) > 1)
    )
    short = F.array_join(F.slice(tokens, 1, FALLBACK_TOKENS), " ")
    return F.when(short != "", short).otherwise(text)


def is_failed_reply(c) -> Column:
    c = col(c)
    return c.isNull() | (c == "") | F.startswith(c, F.lit("ERROR:"))


def accept_expansion(original, reply) -> Column:
    """Cleaned reply if it succeeded and kept every number, else the original text."""
    line = clean_single_line(reply)
    good = ~is_failed_reply(line) & numbers_preserved(original, line)
    return F.when(good, line).otherwise(col(original))


def accept_main_name(original, reply) -> Column:
    line = clean_single_line(reply)
    good = ~is_failed_reply(line) & is_valid_main_name(line)
    return F.when(good, line).otherwise(fallback_main_name(original))


def dimension_values(c) -> Column:
    found = F.regexp_extract_all(replace_missing_text(c), F.lit(DIMENSION), F.lit(1))
    return F.transform(
        found,
        lambda x: F.regexp_replace(F.regexp_replace(F.lower(x), r"\s+", ""), "[a-z]+(?=x)", ""),
    )


def dimension_units(c) -> Column:
    found = F.regexp_extract_all(replace_missing_text(c), F.lit(DIMENSION), F.lit(2))
    return F.transform(found, F.lower)


def level_label(name, level=None) -> Column:
    name = col(name)
    if level is None:
        return name
    lv = col(level).cast("string")
    shown = F.concat(name, F.lit(" (L"), lv, F.lit(")"))
    return F.when(lv.isNull() | (lv == ""), name).otherwise(shown)


def format_percent(fraction) -> Column:
    """Two decimals and a percent sign, rounding half to even on the exact value."""
    pct = F.call_function("format_number", col(fraction) * 100.0, F.lit("0.00"))
    return F.concat(pct, F.lit("%"))


def round_similarity(c) -> Column:
    return F.round(col(c), 4)
