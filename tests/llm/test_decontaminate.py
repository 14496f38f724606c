import random
from collections import Counter

from pyspark.sql import functions as F

from classmap.llm import decontaminate
from tests.llm.tables import SF_DIR, awkward, frame


def grams(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs, items):
    out = []
    for d, text in docs:
        have = grams(text)
        for i, item in items:
            want = grams(item)
            if want and len(want & have) / len(want) >= 0.8:
                out.append((d, i, len(want & have) / len(want)))
    return Counter(out)


def words(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_short_items_inside_long_documents(spark):
    rng = random.Random(8)
    items = [(i, words(rng, rng.choice([3, 5, 6, 7, 9, 14, 30, 70, 200]))) for i in range(120)] + [(900, ""), (901, None), (902, items_text := "a b c")]
    docs = awkward()
    for i, (_, t) in enumerate(items[:120]):
        own = t.split()
        if len(own) > 20 and i % 3 == 0:
            own[len(own) // 2] = "changed"
        docs.append((1000 + i, f"{words(rng, rng.randrange(3000))} {' '.join(own).upper()}\n{words(rng, 500)}"))
    docs += [(2000, items_text), (2001, words(rng, 20_000))]
    names = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    found = decontaminate.contained_items(frame(spark, docs).repartition(4), names)
    want = brute(docs, items)
    assert len(want) > 100
    assert Counter(map(tuple, found.collect())) == want
    # Blocks of items change nothing.
    small = decontaminate.contained_items(frame(spark, docs), names, block_bytes=8000)
    assert Counter(map(tuple, small.collect())) == want
    kept = decontaminate.drop_contaminated(frame(spark, docs), names, block_bytes=20000)
    assert kept.columns == frame(spark, docs).columns
    bad = {d for d, _, _ in want}
    assert Counter(r[0] for r in kept.select("doc_id").collect()) == Counter(d for d, _ in docs if d not in bad)


def test_scattered_shingles_count(spark):
    rng = random.Random(1)
    parts = [words(rng, 12) for _ in range(6)]
    item = [(1, " ".join(parts))]
    doc = [(1, " ".join(words(rng, 400) + " " + " ".join(parts[i : i + 2]) for i in range(5)))]
    names = spark.createDataFrame(item, "item_id bigint, text string")
    found = decontaminate.contained_items(frame(spark, doc), names)
    assert Counter(map(tuple, found.collect())) == brute(doc, item)


def test_given_tables_against_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    found = Counter(map(tuple, decontaminate.contained_items(docs, items).collect()))
    pairs = [[tuple(r) for r in df.select(*df.columns[:2]).collect()] for df in (docs, items)]
    assert found == brute(*pairs) and found


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = frame(spark, awkward())
    assert decontaminate.contained_items(docs, none).count() == 0
    assert decontaminate.drop_contaminated(docs, none).count() == docs.count()
    one = spark.createDataFrame([(1, "a b c d e f")], none.schema)
    assert decontaminate.contained_items(frame(spark, []), one).count() == 0
