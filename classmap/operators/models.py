"""Calling a user-supplied model from Spark tasks.

A model is given as a factory: ``make_fn()`` runs once per task and returns a function
from a list of request texts to a list of replies. Everything around the call (building
requests, answering equal requests once, reading replies) is plain DataFrame work.
"""

from __future__ import annotations

import random
import threading
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col
from classmap.functions.text import nonblank
from classmap.operators.joins import require_columns, require_unique, spread_join
from classmap.operators.rows import fallback_id
from classmap.plans.settle import settle, task_count

# Retries of text models and of embedding models.
RETRIES, DELAY_SECONDS = 3, 2.0
EMBED_RETRIES, EMBED_DELAY_SECONDS, EMBED_BACKOFF, EMBED_JITTER = 8, 1.0, 2.0, 0.1

# Most calls of a task that may hang at the same time.
MOST_HUNG = 16
# Most requests one task should hold: what a lost task has to ask again.
REQUESTS_PER_TASK = 4096


def request_hash(request) -> Column:
    return F.sha2(col(request), 256)


def distinct_requests(df: DataFrame, *, request: str = "request") -> DataFrame:
    """``request_hash, request, n``: equal requests are asked once for their ``n`` rows."""
    keyed = df.where(col(request).isNotNull()).select(
        request_hash(request).alias("request_hash"), col(request).alias("request")
    )
    return keyed.groupBy("request_hash").agg(
        F.any_value("request").alias("request"), F.count(F.lit(1)).alias("n")
    )


def _within(fn: Callable, seconds: float | None) -> Callable:
    """A call that hangs longer fails; its thread is left behind. While ``MOST_HUNG`` such
    threads of a task still run, further calls fail at once."""
    if seconds is None:
        return fn
    left: list[threading.Thread] = []

    def call(batch: list) -> list:
        got: dict = {}
        left[:] = [t for t in left if t.is_alive()]
        if len(left) >= MOST_HUNG:
            raise TimeoutError(f"{len(left)} calls hang")

        def run() -> None:
            try:
                got["replies"] = fn(batch)
            except Exception as e:  # handed to the caller's thread
                got["error"] = e

        thread = threading.Thread(target=run, daemon=True)
        thread.start()
        thread.join(seconds)
        if thread.is_alive():
            left.append(thread)
            raise TimeoutError(f"no reply within {seconds} s")
        if "error" in got:
            raise got["error"]
        return got["replies"]

    return call


def _call(fn: Callable, batch: list) -> list:
    replies = list(fn(batch))
    if len(replies) != len(batch):
        raise ValueError(f"{len(replies)} replies to {len(batch)} requests")
    return replies


def _with_retries(fn: Callable, batch: list, retries: int, delay: float, backoff: float, jitter: float):
    """Replies to a batch; if it fails as a whole, each request gets its own tries."""
    if len(batch) > 1:
        try:
            return _call(fn, batch)
        except Exception:  # the model's errors are unknown here
            return [r for one in batch for r in _with_retries(fn, [one], retries, delay, backoff, jitter)]
    wait, error = delay, "ERROR: not tried"
    for attempt in range(retries):
        try:
            return _call(fn, batch)
        except Exception as e:
            error = f"ERROR: {e}"
        if attempt < retries - 1:
            time.sleep(wait * (1 + random.random() * jitter))
            wait *= backoff
    return [error]


def invoke_model(
    requests: DataFrame,
    make_fn: Callable[[], Callable[[list[str]], list[str]]],
    *,
    retries: int = RETRIES,
    delay: float = DELAY_SECONDS,
    batch: int = 64,
    tasks: int | None = None,
    timeout: float | None = None,
) -> DataFrame:
    """``request_hash, raw`` for distinct requests; a failed call gives ``ERROR: …``.

    A call that takes over ``timeout`` seconds counts as failed.

    ``requests`` should be a stored table: it is counted before it is read.
    """

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = _within(make_fn(), timeout)
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                raw = _with_retries(fn, part["request"].tolist(), retries, delay, 1.0, 0.0)
                yield pd.DataFrame(
                    {"request_hash": part["request_hash"], "raw": [(r or "").strip() for r in raw]}
                )

    tasks = tasks or task_count(requests.sparkSession, requests.count(), batch, REQUESTS_PER_TASK)
    spread = requests.select("request_hash", "request").repartition(tasks)
    return spread.mapInPandas(call, "request_hash string, raw string")


def answer(
    rows: DataFrame, make_fn: Callable, *, request: str, spread_by, **calls
) -> DataFrame:
    """``rows`` with the model's ``raw`` reply to their request (null without a request).

    Requests and replies are both written before they are read, so no later stage can
    repeat a call. The counts taken with the requests tell the join which are frequent.
    """
    asked = settle(distinct_requests(rows, request=request), "asked")
    replies = settle(invoke_model(asked, make_fn, **calls), "replies")
    keyed = rows.withColumn("request_hash", request_hash(request))
    return spread_join(
        keyed, replies, "request_hash", "left", spread_by=spread_by,
        counts=asked.select("request_hash", "n"),
    ).drop("request_hash")


def embed_text(
    df: DataFrame,
    make_fn: Callable[[], Callable[[list[str]], list]],
    *,
    text: str,
    id: str | None = None,
    otherwise: str = "row_pos",
    retries: int = EMBED_RETRIES,
    delay: float = EMBED_DELAY_SECONDS,
    batch: int = 64,
    tasks: int | None = None,
    timeout: float | None = None,
    check_ids: bool = True,
) -> DataFrame:
    """``(id, embedding)`` of rows with text; rows whose call failed are absent.

    Equal texts are embedded once. Repeated ids raise.
    """
    require_columns(df, text)
    rows = df.select(
        fallback_id(df, id, otherwise=otherwise).alias("id"), col(text).cast("string").alias("request")
    ).where(nonblank("request"))
    if check_ids:
        require_unique({"text": (rows, "id")})

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = _within(make_fn(), timeout)
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                vectors = _with_retries(
                    fn, part["request"].tolist(), retries, delay, EMBED_BACKOFF, EMBED_JITTER
                )
                good = [v is not None and not isinstance(v, str) for v in vectors]
                if not any(good):
                    continue
                yield pd.DataFrame(
                    {
                        "request_hash": part["request_hash"][good],
                        "embedding": [v for v, ok in zip(vectors, good) if ok],
                    }
                )

    asked = settle(distinct_requests(rows), "asked")
    tasks = tasks or task_count(df.sparkSession, asked.count(), batch, REQUESTS_PER_TASK)
    spread = asked.select("request_hash", "request").repartition(tasks)
    vectors = settle(spread.mapInPandas(call, "request_hash string, embedding array<double>"), "vectors")
    keyed = rows.select("id", request_hash("request").alias("request_hash"))
    joined = spread_join(
        keyed, vectors, "request_hash", "inner", spread_by="id",
        counts=asked.select("request_hash", "n"),
    )
    return joined.select("id", "embedding")
