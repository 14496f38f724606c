"""Near-duplicates by SimHash and covering locality-sensitive hashing.

A covering family for radius r has 2^(r+1) - 1 tables. Every bit position gets a nonzero
vector of r+1 bits; table v keeps the positions whose vector has an odd product with v.
At most r differing positions span at most r of the r+1 dimensions, so some v is
orthogonal to all of them, and that table masks every difference out: no pair within the
radius is ever missed.

Rows of a table that share a masked fingerprint are compared in the task that holds
them, which emits the links of a spanning forest instead of all pairs. Groups are dealt
out by range, so a hot one is spread over tasks. What a range boundary may have cut, and
groups over a fixed size, are refined by further families of other masks; in the last
one the free bits bound a group's size.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col
from classmap.llm.common import byte_texts, map_batches, sha256_hex, text_or_empty
from classmap.llm.components import components
from classmap.llm.exact_dedup import keep_rows
from classmap.plans.settle import settle

BITS = 64
RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
# Shingles hashed at a time, which bounds the memory for a very long text.
CHUNK = 1 << 16
# Largest group compared as it is; larger ones are refined by the next family of masks.
# After the last one at most 2^13 prints can share a group.
GROUP_ROWS, LEVELS = 4096, 3


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash: a bit is 1 if set in over half of the shingles' hashes.

    A text with fewer words than a shingle is hashed whole; one without words gives 0.
    """
    import xxhash

    split = text.lower().split()
    if not split:
        return 0
    joined = b" ".join(split)
    ends = np.cumsum([len(w) + 1 for w in split]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(words, len(split)) - 1
    ends, starts = ends[last:].tolist(), starts[: len(split) - last].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        pairs = zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_sha256, print`` per row; null text counts as empty."""
    body = text_or_empty(col(text))
    rows = docs.select(col(doc_id).alias("doc_id"), sha256_hex(body).alias("text_sha256"), body.alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            prints = [fingerprint(t) for t in byte_texts(batch.column("text"))]
            return pa.record_batch(
                [batch.column("doc_id"), batch.column("text_sha256"), pa.array(prints, pa.int64())],
                ["doc_id", "text_sha256", "print"],
            )

        return step

    return map_batches(rows, f"doc_id {id_type}, text_sha256 string, print bigint", make)


def covering_masks(level: int, radius: int = RADIUS) -> list[int]:
    """The masks of one family, as signed longs; each level places the vectors anew."""
    size = (1 << (radius + 1)) - 1
    vectors = [i % size + 1 for i in range(BITS)]
    random.Random(level).shuffle(vectors)
    masks = [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in range(1, size + 1)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def differing(a: np.ndarray, b: np.ndarray | np.int64) -> np.ndarray:
    """Numbers of differing bits; ``bitwise_count`` is of the magnitude where signed."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(prints: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links that join all prints reachable from each other in steps within ``radius``."""
    a, b, left = [], [], prints
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = differing(left, at) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                a.extend([int(at)] * len(found))
                b.extend(found.tolist())
                todo.extend(found)
    return a, b


LINK = pa.schema([("t", pa.int32()), ("k", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _link_runs(radius: int, limit: int | None, ranged: bool):
    """Compare runs of equal ``(t, k)`` in rows sorted by them.

    Links come out with a null ``t``. Runs over the limit and, where rows are dealt out
    by range, the first and the last run of a task come out unchanged as ``(t, k, a,
    null)``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the run that is not yet over, as [keys, print]
        rows, key, first, hot = 0, None, True, False

        def opened(t: int, k: int, prints: np.ndarray) -> pa.RecordBatch:
            n = len(prints)
            return pa.record_batch(
                [pa.array(np.full(n, t, np.int32)), pa.array(np.full(n, k)), pa.array(prints), pa.nulls(n, pa.int64())],
                schema=LINK,
            )

        def linked(a: list[int] | np.ndarray, b: list[int] | np.ndarray) -> pa.RecordBatch:
            n = len(a)
            return pa.record_batch(
                [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                schema=LINK,
            )

        def closed(last: bool) -> Iterator[pa.RecordBatch]:
            if not held:
                return
            prints = np.concatenate(held)
            if ranged and (first or last) or hot:
                yield opened(*key, prints)
            elif rows > 1:
                yield linked(*forest(prints, radius))

        for batch in batches:
            if not batch.num_rows:
                continue
            t, k, p = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "k", "print"))
            cut = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1
            starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(t)]))
            pairs = np.zeros(len(starts), bool)
            pairs[1:-1] = (ends - starts == 2)[1:-1]  # whole runs of two, compared at once
            at = starts[pairs]
            near = at[differing(p[at], p[at + 1]) <= radius]
            if len(near):
                yield linked(p[near], p[near + 1])
            own = np.flatnonzero(~pairs & ((ends - starts > 2) | (np.arange(len(starts)) % max(1, len(starts) - 1) == 0)))
            for i in own:
                x = (int(t[starts[i]]), int(k[starts[i]]))
                if x != key:
                    yield from closed(False)
                    first = key is None
                    held, rows, key, hot = [], 0, x, False
                held.append(p[starts[i] : ends[i]])
                rows += int(ends[i] - starts[i])
                if limit is not None and rows > limit:  # too large to hold: pass it on at once
                    hot = True
                    yield opened(*key, np.concatenate(held))
                    held = []
        yield from closed(True)

    return run


def _keyed(prints: DataFrame, masks: list[int]) -> DataFrame:
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("print").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks)])
    return prints.select("print", F.inline(tables).alias("t", "k"))


def covering_links(prints: DataFrame, *, radius: int = RADIUS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links ``a, b`` that connect every two prints within ``radius``, directly or by way
    of others. ``prints`` holds each ``print`` once."""
    schema = "t int, k bigint, a bigint, b bigint"
    kept = covering_masks(0, radius)
    dealt = _keyed(prints, kept).repartitionByRange("t", "k", "print").sortWithinPartitions("t", "k")
    found = settle(dealt.mapInArrow(_link_runs(radius, group_rows, True), schema), "links")
    links = found.where(F.col("t").isNull()).select("a", "b")
    for level in range(1, LEVELS):
        # A refined group agrees on the bits of all its masks; the last ones bound it.
        last, finer = level == LEVELS - 1, covering_masks(level, radius)
        again = _refined(found.where(F.col("t").isNotNull()), kept, finer)
        more = again.repartition("t", "k").sortWithinPartitions("t", "k")
        more = more.mapInArrow(_link_runs(radius, None if last else group_rows, False), schema)
        found = more if last else settle(more, "links")
        links = links.union(found.where(F.col("t").isNull()).select("a", "b"))
        kept = [a | b for a in kept for b in finer]
    return links


def _refined(rows: DataFrame, kept: list[int], finer: list[int]) -> DataFrame:
    """Rows of open groups, once for each table of the next family."""
    tables = F.array(*[F.struct(F.lit(i).alias("t2"), F.lit(m).alias("m2")) for i, m in enumerate(finer)])
    mask = F.element_at(F.array(*map(F.lit, kept)), F.col("t") + 1)
    return rows.select("t", F.col("a").alias("print"), mask.alias("m"), F.inline(tables)).select(
        (F.col("t") * F.lit(len(finer)) + F.col("t2")).cast("int").alias("t"),
        F.col("print").bitwiseAND(F.col("m").bitwiseOR(F.col("m2"))).alias("k"),
        "print",
    )


def _rooted(prints: DataFrame, radius: int, group_rows: int) -> DataFrame:
    """``print, root, least_id`` for each distinct print."""
    nodes = settle(prints.groupBy("print").agg(F.min("doc_id").alias("least_id")), "nodes")
    roots = components(covering_links(nodes.select("print"), radius=radius, group_rows=group_rows))
    return nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least_id", F.coalesce("root", "print").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``,
    the smallest id that links within ``radius`` differing bits lead to.

    Null text counts as empty; texts without words have fingerprint zero and link like
    any other. Rows that repeat an id are separate rows with their own fingerprints. Null
    ids are never the smallest; a component without ids has a null one. Other columns are
    ignored. An empty table gives an empty result.
    """
    prints = settle(fingerprints(docs, doc_id=doc_id, text=text).drop("text_sha256"), "prints")
    rooted = _rooted(prints, radius, group_rows)
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.select("print", "root").join(least, "root").drop("root")
    digits = F.lpad(F.lower(F.hex("print")), 16, "0")
    return prints.join(classes, "print").select("doc_id", digits.alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the
    document with the smallest id (a null id counts as the largest). Should that id occur
    with several texts, the text with the smallest digest stays; rows repeating both
    count as one."""
    prints = settle(fingerprints(docs, doc_id=doc_id, text=text), "prints")
    rooted = _rooted(prints, radius, group_rows).select("print", "root")
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_sha256")
    kept = prints.join(rooted, "print").groupBy("root").agg(F.min(order).alias("first")).select("first.*")
    mark = sha256_hex(text_or_empty(col(text)))
    return keep_rows(docs, kept, "text_sha256", mark, doc_id, text)
