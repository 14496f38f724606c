import random
import zlib
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from classmap.llm import sharding
from tests.llm.tables import awkward, frame


def least_capacity(sizes, shards):
    """Smallest largest shard over all contiguous partitions, by dynamic programming."""
    ends = [0, *accumulate(sizes)]
    best = list(ends)  # with one shard
    for _ in range(shards - 1):
        best = [min(max(best[j], ends[i] - ends[j]) for j in range(i + 1)) for i in range(len(ends))]
    return best[-1]


def greedy(sizes, capacity):
    out, held = [], 0
    for i, s in enumerate(sizes):
        if held + s > capacity:
            out.append(i)
            held = 0
        held += s
    return out


@pytest.mark.parametrize("marks", [4, 8192])
@pytest.mark.parametrize("seed", range(3))
def test_cuts_are_the_best_and_greedy(spark, seed, marks):
    rng = random.Random(seed)
    top = rng.choice([1, 9, 400, 20_000])
    sizes = [rng.randint(1, top) for _ in range(rng.choice([3, 40, 160]))]
    if seed == 2:
        sizes[5 % len(sizes)] = sum(sizes) // 2  # one group with a third of everything
    shards = rng.choice([2, 5, 16])
    ends = list(accumulate(sizes))
    groups = spark.createDataFrame(list(zip(ends, sizes, strict=True)), "end bigint, size bigint")
    capacity, cuts = sharding.minimax_cuts(groups, shards, marks=marks)
    assert capacity == least_capacity(sizes, shards)
    inner = [c for c in cuts[1:] if c < ends[-1]]
    assert [ends.index(c) + 1 for c in inner] == greedy(sizes, capacity)


def brute(rows, shards=16):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return groups


def test_documents(spark):
    rows = awkward()
    found = sharding.shard_documents(frame(spark, rows).repartition(5)).collect()
    assert len(found) == len(rows)
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=repr) == want
    of = {}
    for r in found:
        of.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 16
    assert all(len(s) == 1 for s in of.values())  # equal texts stay together
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for i, t in rows:
        g = groups.setdefault(t or "", [None, 0])
        g[0] = i if g[0] is None else g[0] if i is None else min(g[0], i)
        g[1] += len((t or "").encode()) + 1
    ordered = sorted(groups.values(), key=lambda g: (g[0] is not None, g[0] or 0))
    sizes = {}
    for r in found:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert max(sizes.values()) == least_capacity([g[1] for g in ordered], 16)


def test_small_tables(spark):
    assert sharding.shard_documents(frame(spark, [])).count() == 0
    (one,) = sharding.shard_documents(frame(spark, [(None, None)])).collect()
    assert (one["size"], one["text_crc32"], one["shard"], one["slot"]) == (1, 0, 0, 0)


def test_running_sum_over_sparse_and_null_positions(spark):
    rows = [(None, 5)] + [(i * 10**9, i) for i in range(1, 500)]
    df = spark.createDataFrame(rows, "p bigint, v bigint")
    got = sharding.running(df, ["p"], F.col("v"), "s").orderBy("p").collect()
    assert [r["s"] for r in got] == list(accumulate(v for _, v in rows))
