"""URL filter: host and path rules first, then a weighted vocabulary.

One Aho-Corasick automaton finds all terms of a URL in a single pass. A hit counts only
if no letter or digit touches it on either side. One strict term, or several different
soft terms, block the URL.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col
from classmap.llm.common import ascii_lower, text_or_empty


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Vocabulary:
    strict: tuple[str, ...]
    soft: tuple[str, ...]
    # Different soft terms that together weigh as much as a strict one.
    soft_needed: int = 2


VOCABULARY = Vocabulary(
    strict=("porn", "xxx", "hentai", "escort", "warez", "keygen", "spam", "viagra", "cialis", "malware", "phishing"),
    soft=(
        "adult", "bet", "betting", "bingo", "bonus", "casino", "cheap", "crack", "dating", "deal", "farm", "free",
        "hack", "jackpot", "loan", "lottery", "naked", "nude", "pharmacy", "pill", "pills", "poker", "replica", "sex",
        "sexy", "slots", "torrent", "win",
    ),
)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct of the longest rule that fits (of equally long ones the first), or null."""
    chosen = F.lit(None).cast("struct<rule string, verdict string>")
    for r in sorted(rules, key=lambda r: len(r.name)):  # later ones override
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        chosen = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


class Matcher:
    """Counts strict hits and different soft hits in a URL."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.automaton, self.needed = ahocorasick.Automaton(), vocabulary.soft_needed
        for term, strict in [*((t, False) for t in vocabulary.soft), *((t, True) for t in vocabulary.strict)]:
            self.automaton.add_word(term.lower(), (term.lower(), strict))
        self.automaton.make_automaton()
        self.any = len(self.automaton) > 0

    def hits(self, url: str) -> tuple[int, int]:
        strict, soft = 0, set()
        for end, (term, is_strict) in self.automaton.iter(url) if self.any else ():
            start = end - len(term) + 1
            before, after = url[start - 1 : start] if start else "", url[end + 1 : end + 2]
            if not (before.isalnum() and before.isascii() or after.isalnum() and after.isascii()):
                strict += is_strict
                if not is_strict:
                    soft.add(term)
        return strict, len(soft)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    vocabulary: Vocabulary = VOCABULARY,
    *,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Per row: ``page_id, host, path, rule, verdict, strict_hits, soft_hits``.

    The verdict (allow or block) is that of the longest rule that fits, else the
    vocabulary's: block on one strict hit or ``soft_needed`` different soft hits anywhere
    in the URL, its letters lower-cased. A null URL, or one without ``://``, has an empty
    host and path and fits no rule; a null one has no hits. Rows that repeat an id are
    judged each for itself; other columns, of any name, are ignored.
    """
    address = col(url)
    host, path = text_or_empty(url_host(address)), text_or_empty(url_path(address))
    rows = pages.select(
        col(page_id).alias("page_id"),
        host.alias("host"),
        path.alias("path"),
        fitting_rule(host, path, rules).alias("fit"),
        ascii_lower(text_or_empty(address)).alias("address"),
    ).select("page_id", "host", "path", "fit.rule", "fit.verdict", "address")
    id_type = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(vocabulary)
        for batch in batches:
            hits = [matcher.hits(u) for u in batch.column("address").to_pylist()]
            own = ["block" if s or n >= matcher.needed else "allow" for s, n in hits]
            verdict = [v or o for v, o in zip(batch.column("verdict").to_pylist(), own, strict=True)]
            yield pa.record_batch(
                [
                    *(batch.column(c) for c in ("page_id", "host", "path", "rule")),
                    pa.array(verdict, pa.string()),
                    *(pa.array([h[i] for h in hits], pa.int32()) for i in (0, 1)),
                ],
                ["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits"],
            )

    schema = f"page_id {id_type}, host string, path string, rule string, verdict string, strict_hits int, soft_hits int"
    return rows.mapInArrow(run, schema)
