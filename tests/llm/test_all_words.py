import random

import numpy as np
import pyarrow as pa
import pytest

from classmap.llm import lm_scoring
from tests.llm.tables import awkward, frame
from tests.llm.test_lm_scoring import brute


def test_every_word_counts(spark):
    """More words than any fixed vocabulary held, compared with brute force over all."""
    rows = [r for r in awkward() if r[0] != 400]  # brute force leaves out words over 64 bytes
    rows += [(1000 + i, " ".join(f"rare{i}x{j}" for j in range(60))) for i in range(60)]
    target = [r for r in rows if r[0] is not None and (r[0] < 12 or 1000 <= r[0] < 1003)]
    found = lm_scoring.cross_entropy_difference(frame(spark, rows).repartition(4), frame(spark, target)).collect()
    key = lambda r: repr((r[0], r[1], r[2] and round(r[2], 3)))
    for a, b in zip(sorted(map(tuple, found), key=key), sorted(brute(rows, target, 1 << 30, lm_scoring.SMOOTHING), key=key), strict=True):
        assert a[:2] == b[:2]
        assert (a[2] is None) == (b[2] is None)
        if a[2] is not None:
            np.testing.assert_allclose(a[2:], b[2:], atol=1e-9)


def test_rare_words_tell_documents_apart(spark):
    common = [(i, " ".join(f"w{j}" for j in range(2100)) + " end") for i in range(3)]
    rare = [(10, "w1 w2 rarely"), (11, "w1 w2 seldom")]
    found = lm_scoring.cross_entropy_difference(frame(spark, common * 2 + rare), frame(spark, rare[:1])).collect()
    scores = {r["doc_id"]: r["score"] for r in found}
    assert scores[10] < scores[11]
    assert len(found) == 8


def kept_files(spark):
    """Sizes of Spark's shuffle files on this machine."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_")}


def test_disk_stays_near_the_texts(spark):
    """A chunk's pairs are sent once, packed; a row per document and pair took far more."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=500))) for i in range(800)]
    old = kept_files(spark)
    scored = lm_scoring.cross_entropy_difference(frame(spark, rows, extra=False).coalesce(1), frame(spark, rows[:40], extra=False))
    assert sum(r["n_tokens"] for r in scored.collect()) == 400_000
    new = sum(n for name, n in kept_files(spark).items() if name not in old)
    assert new < 13 * 400_000, f"{new / 400_000:.1f} bytes a word"


def test_chunks_and_pieces_do_not_matter(spark, monkeypatch):
    """Rows cut into several chunks, and these into many pieces and buckets."""
    rows = awkward()
    target = frame(spark, rows[:9])
    whole = lm_scoring.cross_entropy_difference(frame(spark, rows).coalesce(1), target).collect()
    for name, value in (("PIECE_WORDS", 40), ("PIECE_ROWS", 3), ("BUCKET_BYTES", 20_000)):
        monkeypatch.setattr(lm_scoring, name, value)
    key = lambda r: repr((r[0], r[1], r[2] and round(r[2], 6)))
    cut = lm_scoring.cross_entropy_difference(frame(spark, rows).repartition(5), target).collect()
    for a, b in zip(sorted(map(tuple, whole), key=key), sorted(map(tuple, cut), key=key), strict=True):
        assert a[:2] == b[:2]
        assert (a[2] is None) == (b[2] is None)
        if a[2] is not None:
            np.testing.assert_allclose(a[2:], b[2:], atol=1e-12)


def test_chunks_hold_all_rows_once(monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(lm_scoring, "SLICE_BYTES", 1000)
    rng = random.Random(5)
    sizes = [rng.choice([0, 1, 50, 900, 2500]) for _ in range(200)] + [20_000, 20_000, 0, 10]
    batches = [pa.record_batch({"doc_id": list(range(a, a + 17)), "text": ["x" * n if n else None for n in sizes[a : a + 17]]}) for a in range(0, 204, 17)]
    chunks = list(lm_scoring._chunks(iter(batches)))
    assert [i for c in chunks for b in c for i in b.column("doc_id").to_pylist()] == list(range(204))
    for c in chunks:
        ids = [i for b in c for i in b.column("doc_id").to_pylist()]
        assert len(ids) == 1 or sum(sizes[i] + lm_scoring.ROW_BYTES for i in ids) <= 3000
        assert all(b.num_rows == 1 or sum(sizes[i] + lm_scoring.ROW_BYTES for i in b.column("doc_id").to_pylist()) <= 1000 for b in c)
    assert list(lm_scoring._chunks(iter([]))) == []


@pytest.mark.parametrize("values", [[], [0], [0, 0], [255, 256], [2**40, 3, 0], [2**63 - 1]])
def test_packed_numbers_come_back(values):
    assert lm_scoring.unpack(lm_scoring.pack(np.array(values, np.int64))).tolist() == values


def test_packed_keys_come_back():
    keys = np.array([0, 5, 2**63, 2**64 - 1], np.uint64)
    assert lm_scoring.unpack_keys(lm_scoring.pack_keys(keys)).tolist() == keys.tolist()


def test_words_are_those_of_bytes_split():
    texts = [None, "", " \t\n", " A b\x1cC\x0bdé\r\nE ", "ÀB ab c", "x\x85y \x0c z"]
    counts, hashes, place = lm_scoring.word_hashes(pa.array(["out", *texts])[1:])
    words = [(t or "").encode().lower().split() for t in texts]
    assert counts.tolist() == [len(w) for w in words]
    assert hashes[place].tolist() == [lm_scoring.word_hash(w) for x in words for w in x]


@pytest.mark.parametrize("kind", ["string", "timestamp"])
def test_ids_of_other_types(spark, kind):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        docs = spark.range(6).selectExpr(f"cast(cast(id as {'timestamp' if kind == 'timestamp' else 'int'}) as {kind}) k", "concat('a b ', id % 2) body")
        found = lm_scoring.cross_entropy_difference(docs, docs.limit(2), doc_id="k", text="body")
        assert found.schema["doc_id"].dataType.simpleString() == kind
        assert {r["doc_id"] for r in found.collect()} == {r["k"] for r in docs.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
