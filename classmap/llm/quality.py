"""Quality classifier by positive-unlabelled learning.

The non-negative unbiased risk of a score f, with class prior p,

    p * E+[l(f)] + max(0, E[l(-f)] - p * E+[l(-f)])

needs expectations over trusted positives (E+) and over the unlabelled corpus (E) only.
With the squared loss l(z) = (1 - z)^2 / 4 and a score linear in the features, each of
them is a function of the features' first and second moments. So one pass over all
documents gathers two moment matrices of fixed size, no row is sampled, and the exact
risk is minimised from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col
from classmap.llm.common import byte_texts

# Upper ends of the intervals that a share of a text falls into; each interval is a feature.
SHARE_ENDS = (0.0, 0.003, 0.01, 0.03, 0.06, 0.1, 0.15, 0.22, 0.3, 0.4, 0.5, 0.65, 0.8, 0.95)
LENGTH_ENDS = (0, 4, 16, 64, 256, 1024, 4096, 16384)
SHARES = 12
WIDTH = 1 + SHARES * (len(SHARE_ENDS) + 1) + len(LENGTH_ENDS) + 1
RIDGE = 1e-3


def _class_table() -> np.ndarray:
    """Of each byte: letter small, letter large, digit, space, line end, sentence mark,
    other mark, part of a longer code point."""
    kind = np.full(256, 6)
    for i, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:'-")):
        kind[list(chars)] = i
    kind[128:] = 7
    return np.eye(8, dtype=np.int64)[kind]


CLASSES = _class_table()


def shares(text: bytes) -> tuple[list[float], int]:
    """What a text is made of, as shares from 0 to 1, and its number of words."""
    size = max(1, len(text))
    small, large, digit, space, line, mark, other, wide = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ CLASSES
    words = text.split()
    n = max(1, len(words))
    distinct = set(words)
    lines = text.split(b"\n")
    odd = sum(1 for w in words if not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:!?\"')")
    lone = sum(1 for w in words if len(w) == 1 and not w.isalnum() and w[0] < 128)
    echoes = sum(map(bytes.__eq__, words, words[1:]))
    values = [
        large / size, digit / size, mark / size, other / size, wide / size, line / size,
        large / max(1, large + small), odd / n, lone / n, echoes / n,
        1 - len(distinct) / n, 1 - len(set(lines)) / len(lines),
    ]
    return values, len(words)


def codes(texts: list[bytes]) -> np.ndarray:
    """The interval that each share, and last the length, of a text falls into."""
    out = np.zeros((len(texts), SHARES + 1), np.uint8)
    if texts:
        found = [shares(t) for t in texts]
        out[:, :SHARES] = np.searchsorted(SHARE_ENDS, np.array([v for v, _ in found]))
        out[:, SHARES] = np.searchsorted(LENGTH_ENDS, [n for _, n in found])
    return out


def indicators(found: np.ndarray) -> np.ndarray:
    """The features: a constant and one indicator for each interval."""
    out = np.zeros((len(found), WIDTH))
    out[:, 0] = 1
    places = 1 + np.arange(SHARES + 1) * (len(SHARE_ENDS) + 1) + found
    np.put_along_axis(out, places, 1, axis=1)
    return out


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    prior: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """0 to 1. The squared loss is least where f is twice the probability minus one."""
        return np.clip((indicators(codes(texts)) @ np.array(self.weights) + 1) / 2, 0, 1)


def _moments(rows: DataFrame) -> dict[str, np.ndarray]:
    """Sums of x x' over all rows of ``codes, positive`` and over the positives. Each task
    adds up its own rows and sends one entry per cell; Spark adds the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, WIDTH, WIDTH))
        for batch in batches:
            positive = np.array(batch.column("positive").to_pylist(), bool)
            for at in range(0, batch.num_rows, 512):
                part = b"".join(batch.column("codes").slice(at, 512).to_pylist())
                x = indicators(np.frombuffer(part, np.uint8).reshape(-1, SHARES + 1))
                sums[0] += x.T @ x
                p = x[positive[at : at + 512]]
                sums[1] += p.T @ p
        cells = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(cells), pa.array(sums.ravel()[cells])], ["cell", "v"])

    added = rows.mapInArrow(run, "cell bigint, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    sums = np.zeros(2 * WIDTH * WIDTH)
    for cell, v in added.collect():  # at most two matrices of WIDTH x WIDTH
        sums[cell] = v
    whole, positive = sums.reshape(2, WIDTH, WIDTH)
    return {"all": whole, "positive": positive}


def minimise(whole: np.ndarray, positive: np.ndarray, prior: float, ridge: float = RIDGE) -> np.ndarray:
    """Weights of least non-negative unbiased risk, from moment sums whose [0, 0] is the
    number of rows.

    Where the estimated negative part is above zero the risk is a quadratic with one
    minimum. If that minimum makes it negative, the best point lies where it is zero: the
    quadratics ``positive + t * negative`` for t from 1 to 0 lead there.
    """
    a, ap = whole / max(1.0, whole[0, 0]), positive / max(1.0, positive[0, 0])
    b, bp, eye = a[0], ap[0], ridge * np.eye(len(a))

    def negative_part(w: np.ndarray) -> float:
        return float((w @ a @ w + 2 * b @ w + 1 - prior * (w @ ap @ w + 2 * bp @ w + 1)) / 4)

    def best(t: float) -> np.ndarray:
        # d/dw of  p(w'Ap w - 2bp'w) + t(w'A w + 2b'w - p(w'Ap w + 2bp'w))  is zero
        return np.linalg.solve(prior * (1 - t) * ap + t * a + eye, prior * (1 + t) * bp - t * b)

    w = best(1.0)
    if negative_part(w) >= 0:
        return w
    low, high = 0.0, 1.0
    for _ in range(60):
        t = (low + high) / 2
        low, high = (t, high) if negative_part(best(t)) >= 0 else (low, t)
    return best(low)


def estimate_prior(whole: np.ndarray, positive: np.ndarray, labelled: int, good: int) -> float:
    """Share of the positive class: that of the trusted labels where they hold both
    classes; else the smallest ratio of a feature's share among all documents to that
    among the positives, over features that a twentieth of the positives have."""
    if labelled > good:
        return min(0.99, max(0.01, good / labelled))
    have, among = positive[0] / max(1.0, positive[0, 0]), whole[0] / max(1.0, whole[0, 0])
    common = have >= 0.05
    return float(np.clip(np.min(among[common] / have[common], initial=0.5), 0.01, 0.99))


def held_out(doc_id: Column) -> Column:
    """The fold whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality"
) -> Model:
    """Learn from the texts of all documents and the labels outside the held-out fold.

    A document with several labels is positive only if all of them are 1; null labels
    and labels without a document are ignored. Without a positive, every score is 0.5.
    """
    known = (
        labels.where(col(label).isNotNull() & col(doc_id).isNotNull() & ~held_out(col(doc_id)))
        .groupBy(col(doc_id).alias("label_id"))
        .agg(F.min(col(label)).alias("label"))
    )
    counts = known.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("label") == 1).cast("int")), F.lit(0))).first()
    good = known.where("label = 1").select("label_id", F.lit(True).alias("good"))
    rows = _coded(docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")))
    marked = rows.join(good, rows["doc_id"] == good["label_id"], "left")
    moments = _moments(marked.select("codes", F.coalesce("good", F.lit(False)).alias("positive")))
    if not moments["positive"][0, 0]:
        return Model((0.0,) * WIDTH, 0.5)
    prior = estimate_prior(moments["all"], moments["positive"], counts[0], counts[1])
    return Model(tuple(minimise(moments["all"], moments["positive"], prior).tolist()), prior)


def _coded(rows: DataFrame) -> DataFrame:
    """``doc_id, codes``: only these few bytes of a document meet its label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [c.tobytes() for c in codes(list(byte_texts(part.column("text"))))]
                yield pa.record_batch([part.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "codes"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, codes binary")


def score(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted`` (1 from 0.5 on).

    Only the text enters the score; null counts as empty. Null ids are not held out.
    Rows that repeat an id are scored each for itself; other columns are ignored.
    """
    rows = docs.select(col(doc_id).alias("doc_id"), held_out(col(doc_id)).alias("held_out"), col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _scores(model, batch.column("text"))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double, predicted int")


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    parts = [model.scores(list(byte_texts(texts.slice(at, 512)))) for at in range(0, len(texts), 512)]
    return np.concatenate([np.zeros(0), *parts])


def keep_good(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that score 0.5 or more."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch.column(place)) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
