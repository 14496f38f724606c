import hashlib
import random
from collections import Counter

from classmap.llm import line_dedup
from tests.llm.tables import awkward, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows):
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            docs = holders.get(key(line), ())
            docs = {d for d in docs if d is not None}
            if len(docs) < 3 or i == max(docs):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def check(spark, rows, **options):
    found = line_dedup.drop_repeated_lines(frame(spark, rows).repartition(4), **options)
    assert Counter(map(tuple, found.collect())) == brute(rows)


def test_matches_brute_force(spark):
    check(spark, awkward())


def test_many_batches_and_compactions(spark):
    rng = random.Random(6)
    pool = [f"a line that may well repeat number {i}" for i in range(40)] + ["short", "", "É" * 20, "é" * 20, "x" * 19]
    rows = [(rng.randrange(60), "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for _ in range(90)]
    check(spark, rows, batches=5, fanout=2)
    check(spark, rows, batches=1)


def test_an_id_counts_once(spark):
    line = "a line of over twenty letters"
    check(spark, [(1, line), (1, f"{line}\nmore"), (2, line), (None, line), (None, f"{line}\nx")])
    check(spark, [(1, line), (2, line), (3, line), (None, line)])


def test_line_in_every_document(spark):
    rows = [(i, "This very line is in all of the documents\nown") for i in range(600)]
    check(spark, rows)


def test_nothing_to_drop(spark):
    assert line_dedup.drop_repeated_lines(frame(spark, [])).count() == 0
    (row,) = line_dedup.drop_repeated_lines(frame(spark, [(None, None)])).collect()
    assert tuple(row) == (None, 1, 0, "")
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_runs_stay_few(spark):
    runs = line_dedup.Runs(spark, enough=3, fanout=2)
    for i in range(5):
        runs.add(spark.createDataFrame([(bytes([k]), 3 if k == 0 else 1, 100 - i) for k in range(4)], "key binary, n_docs bigint, last_id bigint"))
    assert sum(map(len, runs.levels)) <= 3
    total = {bytes(r["key"]): (r["n_docs"], r["last_id"]) for r in runs.totals().collect()}
    assert total[b"\x00"] == (3, 100)  # held often enough: later batches added nothing
    assert all(last == 100 and n >= 3 for n, last in total.values())
