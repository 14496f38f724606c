"""Hard negatives by exact integer scores from a residue number system.

Vectors are integers. A score is computed modulo several primes, each by a float32 matrix
product whose sums stay below 2^24 and so are exact, and put together by the Chinese
remainder theorem; the primes are as many as the largest possible score needs.

The anchors are compared with all rows in blocks (``plans.blocks``). A first pass finds
each anchor's best rows of its own label; their scores set the windows in which a second
pass looks for rows of other labels. Every block gives its best few per anchor or window,
which a window function merges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from classmap.functions.names import col
from classmap.plans.blocks import BLOCK, SPLIT, block_count, numbered, pair_blocks, split_rows
from classmap.plans.settle import settle

POSITIVES, NEGATIVES = 5, 3
# Bounds of a negative's score as per cent of the positive's.
LOW, HIGH = 50, 95
# Components summed in one product; longer vectors are cut.
SPAN = 256
EXACT = 1 << 24
# Largest score that is told exactly.
LARGEST = 1 << 61
ANCHOR_ROWS = 4096
SPLIT_ROWS = (2048, 65536)
# Scores a task holds at a time.
CELLS = 1 << 21
NEVER = np.iinfo(np.int64).min


def moduli(width: int, largest: int) -> list[int]:
    """Primes for vectors of this width, large enough together for scores up to ``largest``."""
    most = 2 * math.isqrt((EXACT - 1) // max(1, min(width, SPAN))) + 1
    primes, product = [], 1
    for p in range(most, 2, -1):
        if product > 4 * largest + 4:
            return primes
        if all(p % q for q in range(2, math.isqrt(p) + 1)):
            primes.append(p)
            product *= p
    raise ValueError("scores are too large")


def centred(values: np.ndarray, p: int) -> np.ndarray:
    half = p // 2
    return (values + half) % p - half


class Residues:
    """Rows of integers as float32 matrices of centred residues."""

    def __init__(self, rows: np.ndarray, primes: Sequence[int]):
        self.primes = primes
        self.parts = [centred(rows, p).astype(np.float32) for p in primes]

    def take(self, rows: np.ndarray) -> Residues:
        out = object.__new__(Residues)
        out.primes, out.parts = self.primes, [p[rows] for p in self.parts]
        return out


def products(a: Residues, b: Residues) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``."""
    shares = []
    for x, y in zip(a.parts, b.parts, strict=True):
        total = np.zeros((len(x), len(y)), np.int64)
        for at in range(0, x.shape[1], SPAN):
            total += (x[:, at : at + SPAN] @ y[:, at : at + SPAN].T).astype(np.int64)
        shares.append(total)
    return reconstructed(shares, a.primes, -(-a.parts[0].shape[1] // SPAN) if a.parts else 1)


def reconstructed(shares: list[np.ndarray], primes: Sequence[int], spans: int = 1) -> np.ndarray:
    """The signed numbers that leave these remainders, of at most a quarter of the primes' product."""
    whole = math.prod(primes)
    if whole * EXACT * spans * len(primes) < 1 << 62:
        # A weighted sum, less its multiples of the product.
        total = np.zeros_like(shares[0])
        for share, p in zip(shares, primes, strict=True):
            rest = whole // p
            total += share * (rest * pow(rest, -1, p) % whole)
        return total - whole * np.rint(total / whole).astype(np.int64)
    digits: list[np.ndarray] = []  # mixed radix, with digits around zero
    for share, p in zip(shares, primes, strict=True):
        left = share % p
        for digit, q in zip(digits, primes, strict=False):
            left = (left - digit) * pow(q, -1, p) % p
        digits.append(centred(left, p))
    total = digits[-1].copy()
    for digit, p in zip(digits[-2::-1], primes[-2::-1], strict=True):
        total = total * p + digit
    return total


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Integer vectors as rows; shorter ones end in zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


class Side:
    """Rows of a block, by ascending id, with their residues."""

    def __init__(self, table: pa.Table, width: int, primes: Sequence[int]):
        table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        self.table = table
        self.id, self.row = table["vec_id"].to_numpy(), table["row"].to_numpy()
        self.label = table["label"].to_numpy()
        self.residues = Residues(_matrix(table["codes"], width), primes)


def _chunks(anchors: np.ndarray, others: int) -> Iterator[np.ndarray]:
    step = max(1, CELLS // max(1, others))
    return (anchors[a : a + step] for a in range(0, len(anchors), step))


def _best_alike(rows: Side, anchors: Side, most: int) -> pa.Table:
    """The best rows of each anchor's own label in this split, itself left out."""
    out = [np.zeros((0, 4), np.int64)]
    for label in np.unique(anchors.label):
        own = np.flatnonzero(rows.label == label)
        if not len(own):
            continue
        side, names = rows.residues.take(own), rows.row[own]
        for who in _chunks(np.flatnonzero(anchors.label == label), len(own)):
            scores = products(anchors.residues.take(who), side)
            scores[anchors.row[who][:, None] == names[None, :]] = NEVER
            line = np.arange(len(who))
            for _ in range(min(most, len(own))):
                at = scores.argmax(axis=1)  # the first of equals has the smallest id
                value = scores[line, at]
                good = value != NEVER
                out.append(np.stack([anchors.row[who], rows.id[own[at]], names[at], value], axis=1)[good])
                scores[line, at] = NEVER
    return pa.table(list(np.concatenate(out).T.copy()), ["anchor_row", "positive_id", "positive_row", "positive_score"])


def _bounds(score: int) -> tuple[int, int]:
    """Least and largest whole score within the window of a positive."""
    return -(-LOW * score // 100), HIGH * score // 100


def _best_within(rows: Side, anchors: Side, most: int) -> pa.Table:
    """The best rows of other labels within each positive's window in this split."""
    positives = anchors.table["positives"].to_pylist()
    out = []
    for label in np.unique(anchors.label):
        other = np.flatnonzero(rows.label != label)
        if not len(other):
            continue
        side = rows.residues.take(other)
        for who in _chunks(np.flatnonzero(anchors.label == label), len(other)):
            windows = [[(_bounds(p["positive_score"]), p) for p in positives[a]] for a in who.tolist()]
            low = np.array([min((w[0][0] for w in own), default=1) for own in windows])
            high = np.array([max((w[0][1] for w in own), default=0) for own in windows])
            scores = products(anchors.residues.take(who), side)
            line, at = np.nonzero((scores >= low[:, None]) & (scores <= high[:, None]))
            value = scores[line, at]
            order = np.lexsort((at, -value, line))
            at, value = at[order], value[order]
            ends = np.cumsum(np.bincount(line, minlength=len(who)))
            for i, own in enumerate(windows):
                a, b = int(ends[i - 1]) if i else 0, int(ends[i])
                falling = -value[a:b]
                for (lo, hi), p in own:
                    first = a + int(np.searchsorted(falling, -hi))
                    for k in range(first, min(first + most, b)):
                        if value[k] < lo:
                            break
                        j = other[at[k]]
                        out.append((anchors.row[who[i]], p["positive_row"], rows.id[j], rows.row[j], value[k]))
    heads = ["anchor_row", "positive_row", "negative_id", "negative_row", "negative_score"]
    return pa.table(list(np.array(out, np.int64).reshape(-1, 5).T.copy()), heads)


def usable(vector: Column) -> Column:
    """All components are there and finite."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double"))
    )


def hard_negatives(
    vectors: DataFrame,
    *,
    anchor: Column,
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
    scale: float = 256.0,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    anchor_rows: int = ANCHOR_ROWS,
    split: tuple[int, int] = SPLIT_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``; a score is the integer inner product, higher
    ones come first, ties by the smaller id (then by the row). Rows for which ``anchor``
    is true are compared with all rows. An anchor's positives are its first ``positives``
    other rows of the same label. Of each, the first ``negatives`` rows of other labels
    are returned whose score is from 50 to 95 per cent of the positive's, ranked from 1.

    Rows without an id or a label, and those whose vector is null or has a component that
    is null or not finite, take no part. Rows that repeat an id are rows of their own.
    Labels and ids are whole numbers. A shorter vector counts as ending in zeros. Scores
    beyond 2^61 raise. Other columns are ignored; no anchors or an empty table give no rows.
    """
    spark = vectors.sparkSession
    parts = col(embedding)
    rows = vectors.where(col(vec_id).isNotNull() & col(label).isNotNull() & usable(parts)).select(
        col(vec_id).cast("bigint").alias("vec_id"), col(label).cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.transform(parts, lambda x: x.cast("double") * F.lit(scale)).alias("scaled"),
    )
    size = F.aggregate("scaled", F.lit(0.0), lambda total, x: total + (F.abs(x) + 1) * (F.abs(x) + 1))
    n, anchors, width, largest = rows.agg(
        F.count(F.lit(1)), F.count_if("anchor"), F.coalesce(F.max(F.size("scaled")), F.lit(0)), F.coalesce(F.max(size), F.lit(0.0))
    ).first()
    if largest >= LARGEST:
        raise ValueError("scores of 2^61 and more cannot be told exactly")
    primes, width = moduli(width, int(largest)), max(1, width)
    kept = settle(
        rows.select(
            "vec_id", "label", "anchor", F.transform("scaled", lambda x: F.floor(x)).alias("codes"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "vectors",
    )
    splits = block_count(n, split_rows(n, spark.sparkContext.defaultParallelism, *split))
    blocks = block_count(anchors, anchor_rows)
    place = F.xxhash64("row")
    all_rows = kept.select("vec_id", "label", "codes", "row", numbered(place, splits, SPLIT))
    asked = kept.where("anchor").select("vec_id", "label", "codes", "row", numbered(place, blocks, BLOCK))

    def alike(a: pa.Table, b: pa.Table) -> pa.Table:
        return _best_alike(Side(a, width, primes), Side(b, width, primes), positives)

    def within(a: pa.Table, b: pa.Table) -> pa.Table:
        return _best_within(Side(a, width, primes), Side(b, width, primes), negatives)

    found = pair_blocks(
        all_rows, asked, splits, blocks, alike,
        "anchor_row bigint, positive_id bigint, positive_row bigint, positive_score bigint",
    )
    first = Window.partitionBy("anchor_row").orderBy(F.col("positive_score").desc(), "positive_id", "positive_row")
    chosen = settle(found.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= positives).drop("_at"), "positives")

    per_anchor = chosen.groupBy("anchor_row").agg(F.collect_list(F.struct("positive_row", "positive_score")).alias("positives"))
    windows = asked.join(per_anchor.withColumnRenamed("anchor_row", "row"), "row")
    hits = pair_blocks(
        all_rows, windows, splits, blocks, within,
        "anchor_row bigint, positive_row bigint, negative_id bigint, negative_row bigint, negative_score bigint",
    )
    best = Window.partitionBy("anchor_row", "positive_row").orderBy(F.col("negative_score").desc(), "negative_id", "negative_row")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    names = asked.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    told = chosen.join(names, "anchor_row").join(ranked, ["anchor_row", "positive_row"])
    return told.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
