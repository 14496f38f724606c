import zlib

import numpy as np
from pyspark.sql import functions as F

from classmap.llm import quality
from tests.llm.tables import awkward, frame


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    values = np.asarray(scores)[order]
    at = 0
    while at < len(values):
        end = np.searchsorted(values, values[at], side="right")
        ranks[order[at:end]] = (at + end + 1) / 2
        at = end
    good = np.asarray(labels) == 1
    return (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_accuracy_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.score(docs, quality.fit(docs, labels))
    rows = found.join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert auc([r["score"] for r in held], [r["quality"] for r in held]) > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    good = [r for r in held if r["quality"] == 1]
    assert np.mean([r["predicted"] for r in good]) > 0.97


def test_held_out_labels_change_nothing(spark):
    docs = frame(spark, [(i, "good words of prose here" if i % 3 else "$$$ %%% ||| !!!") for i in range(60)])
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id bigint, quality int")
    other = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit(docs, labels) == quality.fit(docs, other)


def risk(w, x, p, prior):
    """The non-negative unbiased risk, from the rows themselves."""
    loss = lambda z: np.mean((1 - z) ** 2) / 4
    return prior * loss(p @ w) + max(0.0, loss(-(x @ w)) - prior * loss(-(p @ w)))


def test_minimum_of_the_risk():
    rng = np.random.default_rng(1)
    for prior in (0.2, 0.5, 0.9):
        p = np.c_[np.ones(60), rng.random((60, 3)) > 0.7].astype(float)
        x = np.r_[p, np.c_[np.ones(80), rng.random((80, 3)) > 0.3]].astype(float)
        w = quality.minimise(x.T @ x, p.T @ p, prior, ridge=1e-9)
        least = risk(w, x, p, prior)
        for _ in range(400):
            assert risk(w + rng.normal(0, rng.choice([1e-3, 0.1, 1]), 4), x, p, prior) >= least - 1e-6


def test_prior():
    moments = np.diag([100.0, 50.0, 50.0])
    moments[0] = [100, 50, 50]
    good = np.zeros((3, 3))
    good[0] = [40, 40, 0]
    assert quality.estimate_prior(moments, good, 10, 8) == 0.8
    assert quality.estimate_prior(moments, good, 8, 8) == 0.5  # from the rarest common feature


def test_awkward_rows(spark):
    rows = awkward()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(0, 1), (0, None), (1, 1), (2, 0), (None, 1), (5, 1), (5, 0), (99, 1)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    found = quality.score(docs, model).collect()
    assert len(found) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["predicted"] for r in found)
    none = quality.fit(docs, labels.where("quality = 0"))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(frame(spark, []), model).count() == 0
    assert quality.fit(frame(spark, []), labels).prior == 0.5
