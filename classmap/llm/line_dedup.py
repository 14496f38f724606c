"""Line deduplication with levelled sorted runs of line hashes, in DataFrame operations.

The documents come in batches of falling ids. A batch's lines become one run: per line
hash the number of its documents and the largest id. Runs of a level are merged into one
run of the next level as soon as there are enough of them, so few runs exist at any time.
A new batch is first anti-joined with the runs: a line that a run already holds often
enough needs no more entries, because its largest id is known from an earlier batch. So a
line in every document adds a row to few runs, however many batches follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from classmap.functions.names import col
from classmap.llm.common import SPACE, ascii_lower, text_or_empty
from classmap.plans.settle import settle

MIN_CHARS, MIN_DOCS = 20, 3
BATCHES, FANOUT = 4, 2


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


class Runs:
    """Runs of ``key, n_docs, last_id``, each written sorted by key, by level."""

    def __init__(self, spark: SparkSession, enough: int, fanout: int = FANOUT):
        self.spark, self.enough, self.fanout = spark, enough, fanout
        self.levels: list[list[DataFrame]] = []

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        both = runs[0]
        for r in runs[1:]:
            both = both.unionByName(r)
        return both.groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("last_id").alias("last_id"))

    def add(self, batch: DataFrame) -> None:
        """Anti-join the batch's entries with the runs and add the rest as a run.

        Every later batch must hold smaller ids than the earlier ones.
        """
        for run in [r for level in self.levels for r in level]:
            known = run.where(F.col("n_docs") >= self.enough).select("key")
            batch = batch.join(known.hint("merge"), "key", "left_anti")
        self._put(0, batch)

    def _put(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(settle(run.sortWithinPartitions("key"), f"run{level}"))
        if len(self.levels[level]) >= self.fanout:
            merged = self._merged(self.levels[level])
            self.levels[level] = []
            self._put(level + 1, merged)

    def totals(self) -> DataFrame:
        runs = [r for level in self.levels for r in level]
        return runs[0] if len(runs) == 1 else self._merged(runs)


def _batch_of(docs: DataFrame, doc_id: str, batches: int) -> Column:
    """0 for the largest ids, which come first; null ids come last."""
    parts = [i / batches for i in range(1, batches)]
    row = docs.agg(F.percentile_approx(col(doc_id), parts)).first() if parts else None
    cuts = sorted(set(row[0])) if row and row[0] else []
    later = sum((F.col("doc_id") <= F.lit(c)).cast("int") for c in cuts) if cuts else F.lit(0)
    return F.coalesce(later, F.lit(len(cuts))), len(cuts) + 1


def drop_repeated_lines(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_lines, n_dropped, kept_text``.

    Texts are split at line feeds; null or empty text is one empty line. Lines whose key
    has ``min_chars`` code points and occurs in ``min_docs`` documents are dropped except
    in the largest id that holds it; the other lines stay in order. Ids must be numbers.
    Rows that repeat an id count as one document for that, whatever their texts; each is
    rewritten by itself, and all of them keep a line for which theirs is the largest id.
    Rows without an id are not counted and lose what others repeat. Other columns are
    ignored. An empty table gives an empty result.
    """
    body = text_or_empty(col(text))
    # What tells documents apart beside their id, should ids repeat.
    whole = docs.select(col(doc_id).alias("doc_id"), body.alias("body")).withColumn("mark", F.xxhash64("body"))
    batch, n_batches = _batch_of(docs, doc_id, batches)
    keyed = whole.select("doc_id", "mark", F.posexplode(F.split("body", "\n")).alias("at", "line")).select(
        "doc_id", "mark", "at", line_key(F.col("line")).alias("line")
    )
    lines = settle(
        keyed.where(F.char_length("line") >= min_chars).select(
            "doc_id", "mark", "at", F.substring(F.unhex(F.sha2("line", 256)), 1, 16).alias("key"), batch.alias("batch")
        ),
        "lines",
    )
    runs = Runs(docs.sparkSession, min_docs, fanout)
    for i in range(n_batches):
        held = lines.where(F.col("batch") == i).select("key", "doc_id").distinct()
        runs.add(held.groupBy("key").agg(F.count("doc_id").alias("n_docs"), F.max("doc_id").alias("last_id")))
    repeated = runs.totals().where(F.col("n_docs") >= min_docs).select("key", "last_id")
    extra = lines.join(repeated, "key").where(~F.col("doc_id").eqNullSafe(F.col("last_id")))
    drops = extra.groupBy(F.col("doc_id").alias("drop_id"), F.col("mark").alias("drop_mark")).agg(
        F.collect_set("at").alias("drops")
    )
    same = F.col("doc_id").eqNullSafe(F.col("drop_id")) & (F.col("mark") == F.col("drop_mark"))
    split = F.split("body", "\n")
    n = F.size(split)
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("drops"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(split, i)), "\n")
    return whole.join(drops, same, "left").select(
        "doc_id",
        n.cast("bigint").alias("n_lines"),
        F.when(F.col("drops").isNull(), F.lit(0)).otherwise(F.size("drops")).cast("bigint").alias("n_dropped"),
        F.when(F.col("drops").isNull(), F.col("body")).otherwise(kept).alias("kept_text"),
    )
