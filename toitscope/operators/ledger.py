"""Ledger of load runs: append-only events, folded to one row per run."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toitscope.functions.measures import seconds_between, share_pct
from toitscope.operators.ranking import latest_per_key, top
from toitscope.operators.storage import read_log

# Run states.
RUNNING, SUCCESS, FAILED = "running", "success", "failed"

EVENT_SCHEMA = (
    "run_id string, scraper_name string, status string, at timestamp_ntz, "
    "records_processed bigint, table_total bigint, error_message string, metadata string, pipeline_id string"
)


def log_event(
    spark: SparkSession,
    path: str,
    run_id: str,
    name: str,
    status: str,
    records: int | None = None,
    total: int | None = None,
    error: str | None = None,
    metadata: dict | None = None,
    pipeline_id: str | None = None,
) -> None:
    """Append one event, stamped with the clock at the time of writing."""
    text = json.dumps(metadata) if metadata else None
    values = {
        "run_id": F.lit(run_id),
        "scraper_name": F.lit(name),
        "status": F.lit(status),
        "at": F.localtimestamp(),
        "records_processed": F.lit(records).cast("bigint"),
        "table_total": F.lit(total).cast("bigint"),
        "error_message": F.lit(error).cast("string"),
        "metadata": F.lit(text).cast("string"),
        "pipeline_id": F.lit(pipeline_id).cast("string"),
    }
    row = spark.range(0, 1, 1, 1).select(*[value.alias(key) for key, value in values.items()])
    row.write.mode("append").parquet(path)


def start_run(
    spark: SparkSession, path: str, name: str, metadata: dict | None = None, pipeline_id: str | None = None
) -> str:
    run_id = uuid.uuid4().hex
    log_event(spark, path, run_id, name, RUNNING, metadata=metadata, pipeline_id=pipeline_id)
    return run_id


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, EVENT_SCHEMA)


def fold_runs(events: DataFrame) -> DataFrame:
    """One row per run: state, start, end, rows loaded, error and metadata from its events."""
    opening, closing = F.col("status") == RUNNING, F.col("status") != RUNNING
    newest = F.struct(closing.cast("int"), F.col("at"))
    return events.groupBy(F.col("run_id").alias("id")).agg(
        F.max("scraper_name").alias("scraper_name"),
        F.min(F.when(opening, F.col("at"))).alias("started_at"),
        F.max(F.when(closing, F.col("at"))).alias("completed_at"),
        F.max_by("status", newest).alias("status"),
        F.coalesce(F.max("records_processed"), F.lit(0).cast("bigint")).alias("records_processed"),
        F.max("table_total").alias("table_total"),
        F.max("error_message").alias("error_message"),
        F.max("metadata").alias("metadata"),
        F.max("pipeline_id").alias("pipeline_id"),
    )


def duration() -> Column:
    return seconds_between(F.col("started_at"), F.col("completed_at")).alias("duration_seconds")


RUN_COLUMNS = ["scraper_name", "started_at", "completed_at", "status", "records_processed"]


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last run of each loader by start time; the greater id breaks ties."""
    newest = latest_per_key(runs, ["scraper_name"], F.struct("started_at", "id"))
    return newest.select(*RUN_COLUMNS, duration())


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    return top(runs, [F.desc("started_at"), F.desc("id")], n)


def runs_since(runs: DataFrame, as_of: Column | None = None, days: int = 7) -> DataFrame:
    """Runs started in the last ``days`` days, newest first."""
    as_of = F.localtimestamp() if as_of is None else as_of
    since = as_of - F.make_dt_interval(F.lit(days))
    return (
        runs.where(F.col("started_at") >= since)
        .select("id", *RUN_COLUMNS, duration())
        .orderBy(F.desc("started_at"), F.desc("id"))
    )


def loader_success(runs: DataFrame) -> DataFrame:
    """Runs, successes and mean rows loaded per loader."""
    return runs.groupBy("scraper_name").agg(
        F.count("*").alias("total_runs"),
        F.sum(F.when(F.col("status") == SUCCESS, 1).otherwise(0)).alias("successes"),
        F.avg("records_processed").alias("avg_records"),
    )


def success_ratio(runs: DataFrame) -> DataFrame:
    """Successes over all runs given."""
    return runs.agg(
        F.count_if(F.col("status") == SUCCESS).alias("nb_success"), F.count("*").alias("nb_total")
    )


def success_ratio_per_run(runs: DataFrame) -> DataFrame:
    """Successes over all loads of each pipeline run, and their share in percent; loads outside a pipeline count together."""
    counted = runs.groupBy("pipeline_id").agg(
        F.count_if(F.col("status") == SUCCESS).alias("nb_success"), F.count("*").alias("nb_total")
    )
    return counted.withColumn("pct_success", share_pct(F.col("nb_success"), F.col("nb_total")))
