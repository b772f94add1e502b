"""Helpers that several corpus operators use."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toitscope.session import shared_folder

BATCH_ROWS = 256
#: Folders of this driver's staged frames that are not dropped yet.
_staged: list[str] = []


def text_of(column: str | Column) -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def small_batches(spark: SparkSession) -> None:
    """Whole texts travel to Python in batches of few rows, so that long ones do not add up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps neither repeat it nor lose it with an executor.

    The folder goes when the driver's session ends; ``drop`` removes it earlier.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    _staged.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def drop(df: DataFrame) -> None:
    """Remove the files of a staged frame that nothing reads any more."""
    _delete(df.sparkSession, df.staged_at)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    if path in _staged:
        _staged.remove(path)


@contextmanager
def step_of(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Work whose result is written when it ends: what it staged goes, but for the frames it puts into the list."""
    before, kept = set(_staged), []
    yield kept
    stay = {df.staged_at for df in kept}
    for path in [p for p in _staged if p not in before and p not in stay]:
        _delete(spark, path)
