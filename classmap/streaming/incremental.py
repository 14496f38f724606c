"""Resumable reranking: replies are appended to a log as they come in.

The log has two tables: which item was asked what (request hash and the candidates
offered), and the reply to each request. Every task commits its replies by itself when it
ends, so a run that is stopped loses only what its running tasks had not committed. An
item is done once a reply to any of its requests was accepted, whatever is asked about it
later: a changed context or margin keeps its choice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from classmap.functions.names import col, cols
from classmap.operators.joins import spread_join
from classmap.operators.models import distinct_requests, invoke_model, request_hash
from classmap.plans.rerank import apply_rerank, rerank_requests, with_rerank_columns
from classmap.plans.settle import settle

RESPONSES = "request_hash string, raw string, asked_at timestamp"


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """All stored replies; none before the first run."""
    try:
        return spark.read.schema(RESPONSES).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RESPONSES)


def checkpoint_responses(replies: DataFrame, path: str) -> None:
    """Append replies, marked with the time of asking. Each task's replies stay, even if
    the job as a whole fails later."""
    stamped = replies.select("request_hash", "raw", F.current_timestamp().alias("asked_at"))
    per_task = stamped.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    per_task.mode("append").parquet(path)


def log_items(requests: DataFrame, path: str, *, item_id: str) -> None:
    """Note which items are asked what, before they are."""
    noted = requests.select(
        col(item_id).alias("item"), request_hash("request").alias("request_hash"), "topk",
        F.current_timestamp().alias("noted_at"),
    )
    noted.write.mode("append").parquet(f"{path}-items")


def resume_items(spark: SparkSession, path: str, *, like: DataFrame, item_id: str) -> DataFrame:
    """``item_id, llm_class_id, llm_class_name, llm_reasoning`` of all items that are done:
    the last accepted reply, judged by the candidates that were offered with it. ``like``
    has the item id and ``topk`` as in the log."""
    kinds = {f.name: f.dataType.simpleString() for f in like.schema}
    schema = f"item {kinds[item_id]}, request_hash string, topk {kinds['topk']}, noted_at timestamp"
    try:
        noted = spark.read.schema(schema).parquet(f"{path}-items")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        noted = spark.createDataFrame([], schema)
    replied = spread_join(noted, latest_responses(read_responses(spark, path)), "request_hash", "inner", spread_by="item")
    judged = apply_rerank(replied).where(F.col("llm_class_id") != "")
    choice = F.struct("llm_class_id", "llm_class_name", "llm_reasoning")
    last = judged.groupBy("item").agg(F.max_by(choice, "noted_at").alias("c"))
    return last.select(F.col("item").alias(item_id), "c.*")


def latest_responses(responses: DataFrame) -> DataFrame:
    """The last reply to each request; only requests that were not done are asked again."""
    return responses.groupBy("request_hash").agg(F.max_by("raw", "asked_at").alias("raw"))


def resume_responses(requests: DataFrame, responses: DataFrame, *, item_id: str) -> DataFrame:
    """Requests with their stored reply and its outcome; ``done`` when it was accepted."""
    keyed = requests.withColumn("request_hash", request_hash("request"))
    carried = spread_join(
        keyed, latest_responses(responses), "request_hash", "left", spread_by=item_id
    )
    judged = apply_rerank(carried)
    done = F.col("raw").isNotNull() & F.coalesce(F.col("llm_class_id") != "", F.lit(False))
    return judged.withColumn("done", done)


def resume_anti(requests: DataFrame, resumed: DataFrame, *, item_id: str) -> DataFrame:
    """The worklist: requests of the items that are not done."""
    return requests.join(resumed.where("done").select(item_id), item_id, "left_anti")


def carry_forward(assigned: DataFrame, resumed: DataFrame, *, item_id: str) -> DataFrame:
    """Assigned rows with the accepted choices of earlier runs."""
    return with_rerank_columns(assigned, resumed.where("done"), item_id=item_id)


def incremental_rerank(
    assigned: DataFrame,
    items: DataFrame,
    make_fn: Callable,
    *,
    responses_path: str,
    item_id: str,
    item_name: str,
    autosave_every: int | None = None,
    calls: dict | None = None,
    **requests,
) -> DataFrame:
    """Rerank what is not done yet, saving about every ``autosave_every`` calls.

    Failed or rejected replies are not done and are asked again by the next run. A request
    that was answered before, for any item, is not asked again. All calls are one job; its
    tasks hold ``autosave_every`` requests each.
    """
    spark = assigned.sparkSession
    done = settle(resume_items(spark, responses_path, like=assigned, item_id=item_id), "done")
    open_ = assigned.join(done.select(item_id), item_id, "left_anti")
    asked = settle(
        rerank_requests(open_, items, item_id=item_id, item_name=item_name, **requests),
        "requests",
    )
    resumed = resume_responses(asked, read_responses(spark, responses_path), item_id=item_id)
    work = settle(distinct_requests(resume_anti(asked, resumed, item_id=item_id)), "worklist")
    log_items(asked, responses_path, item_id=item_id)
    pending = work.count()
    if pending:
        limits = dict(calls or {})
        if autosave_every:
            limits["tasks"] = -(-pending // autosave_every)
        checkpoint_responses(invoke_model(work, make_fn, **limits), responses_path)
    replied = resume_responses(asked, read_responses(spark, responses_path), item_id=item_id)
    heads = [item_id, "llm_class_id", "llm_class_name", "llm_reasoning"]
    judged = done.select(*cols(heads)).union(replied.where("raw is not null").select(*cols(heads)))
    return with_rerank_columns(assigned, judged, item_id=item_id)
