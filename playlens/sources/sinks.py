"""Sinks: Parquet and CSV directories, sliced and partitioned output, ALS model persistence.

Writes are idempotent (``overwrite``) so a rerun after a lost job leaves one copy of the output.
"""

from __future__ import annotations

import math
import uuid

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession

from playlens.session import ensure_checkpoint_dir


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = False) -> None:
    """Headerless CSV by default (the usage-table format read back by ``read_usage_csv``)."""
    df.write.mode(mode).option("header", str(header).lower()).csv(path)


def write_slices(df: DataFrame, path: str, slices: int = 10, mode: str = "overwrite") -> None:
    """Output in ``slices`` files of similar size (a table too big for one file).

    ``repartition(slices)`` is a round-robin shuffle: no row is lost or duplicated, file sizes even.
    """
    df.repartition(slices).write.mode(mode).parquet(path)


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the data files of a written table, from the file system that holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def write_sized(df: DataFrame, path: str, file_bytes: int = 256 << 20, mode: str = "overwrite") -> int:
    """Output in files of about ``file_bytes``, as many as the rows need; returns their number.

    Parquet size is known only once it is written, so the rows go to the shared scratch folder first, are
    measured there, and are dealt to that many files.
    """
    spark = df.sparkSession
    staged = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(staged)
    files = max(1, math.ceil(table_bytes(spark, staged) / file_bytes))
    spark.read.schema(df.schema).parquet(staged).repartition(files).write.mode(mode).parquet(path)
    return files


def write_max_records(df: DataFrame, path: str, max_records: int, mode: str = "overwrite") -> None:
    """Split files by row count instead of by number, without a shuffle."""
    df.write.mode(mode).option("maxRecordsPerFile", max_records).parquet(path)


def write_partitioned(df: DataFrame, path: str, *cols: str, mode: str = "overwrite") -> None:
    """One folder per value of ``cols`` (e.g. one per duration quartile); readers prune folders."""
    df.write.mode(mode).partitionBy(*cols).parquet(path)


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)
