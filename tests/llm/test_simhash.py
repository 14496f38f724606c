import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from classmap.llm import simhash
from classmap.llm.components import components
from tests.llm.tables import awkward, frame


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    """Smallest reachable index of each node."""
    root = list(range(len(nodes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i], nodes[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(nodes))]


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints, lambda x, y: (x ^ y).bit_count() <= 3)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [(i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, roots, strict=True)]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_every_pair_within_the_radius_collides():
    rng = random.Random(3)
    for level in range(simhash.LEVELS):
        masks = [m & (1 << 64) - 1 for m in simhash.covering_masks(level)]
        assert len(masks) == 15
        for _ in range(3000):
            changed = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(not m & changed for m in masks)


def test_refined_groups_are_bounded():
    families = [[m & (1 << 64) - 1 for m in simhash.covering_masks(i)] for i in range(simhash.LEVELS)]
    free = [64 - (a | b | c).bit_count() for a in families[0] for b in families[1] for c in families[2]]
    assert max(free) <= 13


def test_long_text_is_hashed_in_chunks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(500))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text.encode()) == whole
    assert whole & (1 << 64) - 1 == brute_print(text)


def test_matches_brute_force(spark):
    rows = awkward()
    found = simhash.near_duplicates(frame(spark, rows).repartition(4))
    assert ordered(found.collect()) == ordered(brute(rows))
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_links_connect_what_brute_force_connects(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(30)]
    prints = set()
    for c in centres:
        for _ in range(40):
            x = c
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            prints.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in sorted(prints)]
    roots = brute_components(signed, lambda x, y: ((x ^ y) & (1 << 64) - 1).bit_count() <= 3)
    want = {}
    for x, r in zip(signed, roots, strict=True):
        want.setdefault(r, set()).add(x)
    df = spark.createDataFrame([(x,) for x in signed], "print bigint")
    for limit in (4096, 3):  # 3 sends nearly all groups to the second family
        links = simhash.covering_links(df, group_rows=limit)
        got = {x: x for x in signed} | {r["node"]: r["root"] for r in components(links).collect()}
        classes = {}
        for x, r in got.items():
            classes.setdefault(r, set()).add(x)
        assert sorted(map(sorted, classes.values())) == sorted(map(sorted, want.values()))


def test_hot_cluster_gives_few_links(spark):
    rng = random.Random(9)
    near = {sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(2500)}
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in near], "print bigint")
    links = simhash.covering_links(df).collect()
    assert len(links) < 16 * len(near)
    roots = components(spark.createDataFrame(links)).select("root").distinct().count()
    assert roots == 1


def test_forest_reaches_all():
    chain = np.array([0, 7, 63, 511, 0x5555 << 40], np.int64)
    a, b = simhash.forest(chain, 3)
    assert len(a) == 3 and {*a, *b} == {0, 7, 63, 511}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    nodes = sorted({x for e in edges for x in e})
    near = {(a, b) for a, b in edges} | {(b, a) for a, b in edges}
    roots = brute_components(nodes, lambda x, y: (x, y) in near)
    want = {x: nodes[r] for x, r in zip(nodes, roots, strict=True) if x != nodes[r]}
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r["node"]: r["root"] for r in found.collect()} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_stage_keeps_one_of_each_component(spark):
    rows = awkward()
    df = frame(spark, rows)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints, lambda x, y: (x ^ y).bit_count() <= 3)
    got = kept.select("doc_id", "text").collect()
    of = {}
    for (i, t), r in zip(rows, roots, strict=True):
        of.setdefault(r, []).append((i, t))
    assert len(got) == len(of)
    for members in of.values():
        ids = [i for i, _ in members if i is not None]
        (stays,) = [tuple(g) for g in got if tuple(g) in members]
        assert stays[0] == (min(ids) if ids else None)
    assert simhash.drop_near_duplicates(df.where(F.lit(False))).count() == 0
