"""Each landed file is cleaned and loaded once.

The file source remembers paths, so every delivery has to land under a new path (a dated folder). A run takes
all files that are new since the last one and stops. A batch that is repeated after a failure overwrites what it
left before, so nothing is loaded twice. The checkpoint says what was taken and belongs to one target: the caller
names it, in a folder that outlives the session.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from toitscope.operators.commits import in_transaction
from toitscope.operators.storage import staging
from toitscope.plans.loading import store_transactions
from toitscope.schemas import TRANSACTIONS_SOURCE, Source
from toitscope.sources.delimited import csv_options, header_schema, joined_lines, located, shape, with_corrupt
from toitscope.sources.quoted import located_lines


def ingest(
    stream: DataFrame,
    target: str,
    prepare: Callable[[DataFrame], DataFrame],
    checkpoint: str,
) -> None:
    """Run ``prepare`` on every new batch of ``stream`` and store it under ``target``, then stop."""

    def load(batch: DataFrame, batch_id: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_reader(spark: SparkSession, glob: str, files_per_batch: int | None = None) -> DataStreamReader:
    reader = spark.readStream.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    return stream_reader(spark, glob, files_per_batch).schema(schema).parquet(path)


def stream_delimited(
    spark: SparkSession,
    path: str,
    source: Source,
    separator: str | None = None,
    glob: str = "*.csv",
    files_per_batch: int | None = None,
    quoted_breaks: bool = False,
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """A stream of the delimited files under ``path`` and what shapes a batch of it like the batch read.

    A header that differs from the first file's stops the run.
    """
    separator = separator or source.separator
    schema = header_schema(spark, path, separator, glob, folders=False)
    if quoted_breaks:
        lines = located_lines(stream_reader(spark, glob, files_per_batch).text(path))
        return lines, lambda batch: shape(joined_lines(batch, schema, separator), schema, source)
    reader = stream_reader(spark, glob, files_per_batch).schema(with_corrupt(schema))
    stream = located(reader.options(**csv_options(separator)).csv(path))
    return stream, lambda batch: shape(batch, schema, source)


def ingest_delimited(
    spark: SparkSession,
    path: str,
    source: Source,
    clean: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    separator: str | None = None,
    glob: str = "*.csv",
    files_per_batch: int | None = None,
    quoted_breaks: bool = False,
) -> None:
    """Clean every delimited file under ``path`` that no earlier run took and store it under ``target``."""
    stream, shaped = stream_delimited(spark, path, source, separator, glob, files_per_batch, quoted_breaks)
    ingest(stream, target, lambda batch: clean(shaped(batch)), checkpoint)


def ingest_transactions(
    spark: SparkSession,
    path: str,
    warehouse: str,
    checkpoint: str,
    separator: str | None = None,
    files_per_batch: int | None = None,
    only_new: bool = False,
    quoted_breaks: bool = False,
) -> None:
    """Load sales that landed under ``path`` since the last run into the warehouse: rules, register and quarantine as
    in the batch load, each batch under a load id made of the checkpoint and its number.

    With ``only_new`` a delivery that repeats stored sales, under whatever path, adds only those beyond them.
    """
    stream, shaped = stream_delimited(
        spark, path, TRANSACTIONS_SOURCE, separator, files_per_batch=files_per_batch, quoted_breaks=quoted_breaks
    )
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def load(batch: DataFrame, batch_id: int) -> None:
        with staging(batch.sparkSession):
            rows, load_id = shaped(batch), f"stream-{name}-{batch_id}"
            in_transaction(
                batch.sparkSession, warehouse, lambda: store_transactions(rows, warehouse, only_new, "quarantine", load_id)
            )

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
