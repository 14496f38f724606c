"""Abbreviation lists: parsing, per-sheet replacement maps, replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col, cols
from classmap.functions.text import nonblank, strip, text_of
from classmap.operators.joins import require_columns, spread_join
from classmap.plans.settle import release, settle

# Bytes of replacement pairs that may be broadcast where all of a sheet's are needed.
PAIR_BYTES = 64 << 20


def parse_abbreviations(df: DataFrame, *, list_col: str = "_c0", sheet_col: str = "_c1") -> DataFrame:
    """``Code, Description, Sheet`` from cells like ``"A=b, C=d"``.

    An entry without ``=`` is a code with an empty description; null cells are skipped.
    """
    keep = [c for c in ("row_pos",) if c in df.columns]
    entries = df.where(col(list_col).isNotNull()).select(
        *keep, col(sheet_col).alias("Sheet"),
        F.posexplode(F.split(col(list_col).cast("string"), ",")).alias("entry_pos", "entry"),
    )
    entry = strip("entry")
    at = F.instr(entry, "=")
    code = F.when(at > 0, F.substring(entry, F.lit(1), at - 1)).otherwise(entry)
    text = F.when(at > 0, F.substring(entry, at + 1, F.length(entry))).otherwise(F.lit(""))
    return entries.select(
        *keep, "entry_pos", strip(code).alias("Code"), strip(text).alias("Description"), "Sheet"
    )


def abbreviation_table(df: DataFrame, *, list_col: str = "_c0", sheet_col: str = "_c1") -> DataFrame:
    return parse_abbreviations(df, list_col=list_col, sheet_col=sheet_col).select(
        "Code", "Description", "Sheet"
    )


def trim_fields(
    abbr: DataFrame, *, code: str = "Code", description: str = "Description",
    sheet: str = "Sheet", position: str = "row_pos",
) -> DataFrame:
    """Stripped ``code, descr, sheet, row_pos``; empty codes and sheets are dropped.

    An empty description is null: its code is not replaced.
    """
    require_columns(abbr, code, description, sheet, position)
    kinds = dict(abbr.dtypes)
    fields = abbr.select(
        strip(text_of(code, kinds[code])).alias("code"),
        F.nullif(strip(text_of(description, kinds[description])), F.lit("")).alias("descr"),
        strip(text_of(sheet, kinds[sheet])).alias("sheet"),
        col(position).alias("row_pos"),
    )
    return fields.where((F.col("code") != "") & (F.col("sheet") != ""))


def ambiguous_codes(trimmed: DataFrame) -> DataFrame:
    """Codes with more than one description in their sheet."""
    per_code = trimmed.groupBy("sheet", "code").agg(F.countDistinct("descr").alias("descriptions"))
    return per_code.where("descriptions > 1")


def first_descriptions(trimmed: DataFrame) -> DataFrame:
    """First description per sheet and code; a code without one is not replaced."""
    first = F.min(F.struct("row_pos", "descr"))
    per_code = trimmed.groupBy("sheet", "code").agg(first.alias("f"))
    return per_code.select("sheet", "code", F.col("f.descr").alias("descr"), F.col("f.row_pos").alias("row_pos")).where(
        F.col("descr").isNotNull()
    )


def replacement_map(trimmed: DataFrame) -> DataFrame:
    """Per sheet ``pairs array<struct(code, descr)>``, longest code first, then by row."""
    ordered = F.array_sort(
        F.collect_list(F.struct((-F.length("code")).alias("shorter"), "row_pos", "code", "descr"))
    )
    pairs = F.transform(ordered, lambda p: F.struct(p["code"].alias("code"), p["descr"].alias("descr")))
    return first_descriptions(trimmed).groupBy("sheet").agg(pairs.alias("pairs"))


def sheet_lookup(items: DataFrame, codes: DataFrame, *, sheet: str, spread_by: str) -> DataFrame:
    """Items with ``n_pairs``, the number of codes their sheet has, null without any.

    ``codes`` are :func:`first_descriptions`. Codes stay rows; only their number is joined.
    """
    sizes = codes.groupBy("sheet").agg(F.count(F.lit(1)).cast("int").alias("n_pairs"))
    joined = spread_join(items, sizes.withColumnRenamed("sheet", sheet), sheet, "left", spread_by=spread_by)
    return joined.select(*cols([*items.columns, "n_pairs"]))


def sheet_pairs(items: DataFrame, pairs: DataFrame, *, sheet: str, spread_by: str) -> DataFrame:
    """Items with all ``pairs`` of their sheet, for replacements inside of words, where any
    code may apply to any text. A small map (measured) is broadcast; otherwise sheets are
    joined, hot ones split."""
    side = pairs.select(F.col("sheet").alias(sheet), "pairs")
    size = F.sum(F.octet_length(F.to_json("pairs")) + F.octet_length(sheet))
    if (side.agg(size).first()[0] or 0) <= PAIR_BYTES:
        joined = items.join(F.broadcast(side), sheet, "left")
    else:
        joined = spread_join(items, side, sheet, "left", spread_by=spread_by)
    return joined.select(*cols([*items.columns, "pairs"]))


def unmatched_sheets(items: DataFrame, codes: DataFrame, *, sheet: str) -> DataFrame:
    """Sheets with replacements that the items do not have."""
    present = items.select(col(sheet).alias("sheet")).distinct()
    return codes.select("sheet").distinct().join(present, "sheet", "left_anti")


def _fold(text: Column, case_sensitive: bool) -> Column:
    """Letters that count as the same without case get one form."""
    if case_sensitive:
        return text
    return F.translate(F.lower(F.translate(text, "\u0130", "i")), "\u017f\u212a\u0131", "ski")


def _tokens(text: Column) -> Column:
    """The different words of a text, and its other characters."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("([A-Za-z0-9_]+|[^A-Za-z0-9_])"), 1))


def keyed_codes(codes: DataFrame, *, case_sensitive: bool = True) -> DataFrame:
    """Codes as ``sheet, key, pair``. Where a code matches as whole tokens, each of its words
    is a whole word of the text, so its longest one can be looked up; a code without words
    is looked up by its first character. ``pair`` sorts in the order of replacement."""
    folded = _fold(F.col("code"), case_sensitive)
    words = F.regexp_extract_all(folded, F.lit("([A-Za-z0-9_]+)"), 1)
    longest = F.array_max(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    pair = F.struct((-F.length("code")).alias("shorter"), "row_pos", "code", "descr")
    return codes.select("sheet", F.coalesce(longest, F.left(folded, F.lit(1))).alias("key"), pair.alias("pair"))


def following_codes(keyed: DataFrame, *, case_sensitive: bool = True) -> DataFrame:
    """``sheet, code, after``: the later pairs that the descriptions of a code, or of those
    that follow it, can bring into a text. A description keeps its words whole, so they
    are looked up like those of a text. Ways are joined with ways until there are no more."""
    tokens = F.explode(_tokens(_fold(F.col("pair.descr"), case_sensitive)))
    said = keyed.select("sheet", F.col("pair").alias("first"), tokens.alias("key"))
    later = said.join(keyed.withColumnRenamed("pair", "after"), ["sheet", "key"]).where("after > first")
    ways = settle(later.select("sheet", F.col("first.code").alias("code"), "after").distinct(), "following")
    n = ways.count()
    while n:
        on = ways.select("sheet", F.col("code").alias("_code"), F.col("after").alias("_after"))
        more = ways.join(on.withColumnRenamed("sheet", "_sheet"), (F.col("sheet") == F.col("_sheet")) & (F.col("after.code") == F.col("_code")))
        longer = settle(ways.union(more.select("sheet", "code", "_after")).distinct(), "following")
        release(ways)
        ways, before, n = longer, n, longer.count()
        if n == before:
            break
    return ways


def matched_pairs(
    items: DataFrame,
    codes: DataFrame,
    *,
    row: str,
    texts: Sequence[str] = (),
    numbers: Sequence[str] = (),
    sheet: str = "sheet",
    case_sensitive: bool = True,
) -> DataFrame:
    """``row, pairs map<column, array<struct(shorter, row_pos, code, descr)>>``: for each
    cell the pairs that can apply to it, in order.

    Cells and codes meet as rows by sheet and word, or by the whole text of a number; hot
    words are split. An array holds what one cell's words bring in, whatever the sheet's
    number of codes.
    """
    kinds = dict(items.dtypes)
    keyed = settle(keyed_codes(codes, case_sensitive=case_sensitive), "codes")
    following = following_codes(keyed, case_sensitive=case_sensitive)
    thin = [col(row).alias("_row"), col(sheet).alias("sheet")]
    found = None
    if texts:
        cells = F.array(*[F.struct(F.lit(c).alias("c"), col(c).alias("t")) for c in texts])
        said = items.select(*thin, F.explode(cells).alias("cell"))
        tokens = said.select("_row", "sheet", F.col("cell.c").alias("_column"), F.explode(_tokens(_fold(F.col("cell.t"), case_sensitive))).alias("key"))
        direct = spread_join(tokens, keyed, ["sheet", "key"], "inner", spread_by="_row").select("_row", "_column", "sheet", "pair")
        indirect = direct.join(
            following.select(F.col("sheet").alias("_sheet"), F.col("code").alias("_code"), "after"),
            (F.col("sheet") == F.col("_sheet")) & (F.col("pair.code") == F.col("_code")),
        )
        found = direct.select("_row", "_column", "pair").union(indirect.select("_row", "_column", "after"))
    if numbers:
        cells = F.array(*[F.struct(F.lit(c).alias("c"), text_of(c, kinds[c]).alias("t")) for c in numbers])
        said = items.select(*thin, F.explode(cells).alias("cell")).select("_row", "sheet", F.col("cell.c").alias("_column"), F.col("cell.t").alias("code"))
        exact = keyed.select("sheet", F.col("pair.code").alias("code"), "pair")
        whole = spread_join(said, exact, ["sheet", "code"], "inner", spread_by="_row").select("_row", "_column", "pair")
        found = whole if found is None else found.union(whole)
    cells = found.groupBy("_row", "_column").agg(F.array_sort(F.collect_set("pair")).alias("_list"))
    return cells.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_column", "_list"))).alias("pairs")).withColumnRenamed("_row", row)


def replace_abbreviations(
    text, pairs, *, whole_tokens: bool = True, case_sensitive: bool = True
) -> Column:
    """Apply every pair in order; later pairs see earlier replacements.

    Whole-token mode needs no letter, digit or underscore on either side of the code.
    Descriptions are literal text.
    """
    text, pairs = (col(c) if isinstance(c, str) else c for c in (text, pairs))
    before, after = (r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])") if whole_tokens else ("", "")
    fold = "" if case_sensitive else "(?iu)"

    def apply(acc: Column, pair: Column) -> Column:
        quoted = F.replace(pair["code"], F.lit(r"\E"), F.lit(r"\E\\E\Q"))
        pattern = F.concat(F.lit(fold + before + r"\Q"), quoted, F.lit(r"\E" + after))
        literal = F.replace(
            F.replace(pair["descr"], F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$")
        )
        replaced = F.regexp_replace(acc, pattern, literal)
        # A plain substring test spares compiling patterns that cannot match.
        return F.when(F.contains(acc, pair["code"]), replaced).otherwise(acc) if case_sensitive else replaced

    done = F.aggregate(pairs, text, apply)
    return F.when(pairs.isNull() | ~nonblank(text), text).otherwise(done)


def replace_numeric_cell(value, dtype: str, pairs) -> Column:
    """Text of a number, replaced only when all of it is a code."""
    pairs = col(pairs) if isinstance(pairs, str) else pairs
    text = text_of(value, dtype)
    exact = F.filter(pairs, lambda p: p["code"] == text)
    return F.coalesce(F.get(exact, F.lit(0))["descr"], text)


def replace_in_sheets(
    items: DataFrame,
    abbr: DataFrame,
    *,
    sheet: str = "sheet",
    columns: Sequence[str] | None = None,
    position: str = "row_pos",
    whole_tokens: bool = True,
    case_sensitive: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The items with replaced text and whole-number cells, and a table of warnings.

    Numeric columns become text, since a code's description is text. Booleans and the
    sheet and position columns are left alone.
    """
    trimmed = trim_fields(abbr)
    codes = settle(first_descriptions(trimmed), "codes")
    kinds = dict(items.dtypes)
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    wanted = columns or [c for c in items.columns if c not in (sheet, position)]
    texts = [c for c in wanted if kinds[c] == "string"]
    numbers = [c for c in wanted if kinds[c] in numeric]

    def pairs_of(c: str) -> Column:
        return F.try_element_at(col("_pairs"), F.lit(c))

    rows = settle(items.withColumn("_row", F.monotonically_increasing_id()), "rows")
    looked_up = rows.withColumn("_pairs", F.lit(None).cast("map<string,array<struct<code:string,descr:string>>>"))
    exact = texts if whole_tokens else []
    if exact or numbers:
        found = matched_pairs(
            rows, codes, row="_row", texts=exact, numbers=numbers, sheet=sheet, case_sensitive=case_sensitive
        )
        looked_up = rows.join(found.withColumnRenamed("pairs", "_pairs"), "_row", "left")
    if texts and not whole_tokens:
        looked_up = sheet_pairs(looked_up, replacement_map(trimmed), sheet=sheet, spread_by="_row").withColumnRenamed("pairs", "_all")

    def cell(c: str) -> Column:
        if c in texts:
            pairs = pairs_of(c) if whole_tokens else F.col("_all")
            return replace_abbreviations(
                c, pairs, whole_tokens=whole_tokens, case_sensitive=case_sensitive
            ).alias(c)
        if c in numbers:
            return replace_numeric_cell(c, kinds[c], pairs_of(c)).alias(c)
        return col(c)

    data = looked_up.select(*[cell(c) for c in items.columns])
    ambiguous = ambiguous_codes(trimmed).select(
        F.lit("ambiguous code").alias("warning"), "sheet", "code"
    )
    absent = unmatched_sheets(items, codes, sheet=sheet).select(
        F.lit("sheet not found").alias("warning"), "sheet", F.lit(None).cast("string").alias("code")
    )
    return data, ambiguous.unionByName(absent)
