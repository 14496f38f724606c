import hashlib
from collections import Counter

from pyspark.sql import functions as F

from classmap.llm import exact_dedup
from tests.llm.tables import awkward, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for i, t in rows:
        body = (t or "").translate(LOWER)
        keep = max((x for x in groups[body] if x is not None), default=None)
        out.append((i, keep, len(groups[body]), i == keep, hashlib.sha256(body.encode()).hexdigest()))
    return Counter(out)


def test_matches_brute_force(spark):
    rows = awkward()
    found = exact_dedup.exact_duplicates(frame(spark, rows).repartition(5))
    assert Counter(map(tuple, found.collect())) == brute(rows)


def test_texts_are_compared_whole_when_digests_clash(spark):
    rows = awkward()
    weak = lambda c: F.substring(F.sha2(c, 256), 1, 1)
    found = exact_dedup.exact_duplicates(frame(spark, rows).repartition(5), digest=weak, salts=3)
    assert Counter(map(tuple, found.collect())) == brute(rows)


def test_stage_keeps_one_row_of_each_text(spark):
    rows = awkward()
    df = frame(spark, rows)
    kept = exact_dedup.drop_exact_duplicates(df)
    assert kept.columns == df.columns
    texts = [(r["text"] or "").translate(LOWER) for r in kept.collect()]
    want = {(t or "").translate(LOWER) for _, t in rows}
    # Null and empty text of id null and 300 are one group, kept in its largest id.
    assert sorted(texts) == sorted(want)


def test_hot_group_and_empty_table(spark):
    rows = [(i, "Same") for i in range(3000)] + [(5000 + i, f"t{i}") for i in range(50)]
    found = exact_dedup.exact_duplicates(frame(spark, rows).repartition(7))
    assert Counter(map(tuple, found.collect())) == brute(rows)
    assert exact_dedup.exact_duplicates(frame(spark, [])).count() == 0
    assert exact_dedup.drop_exact_duplicates(frame(spark, [])).count() == 0
