"""Readers for the test tables and for the interaction / factor files the jobs exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

def usage_schema(id_type: T.DataType) -> T.StructType:
    """Headerless per-item usage CSV (item id, distinct listeners, total plays)."""
    counts = [T.StructField("unique_plays", T.LongType()), T.StructField("total_plays", T.LongType())]
    return T.StructType([T.StructField("track_id", id_type), *counts])


ITEM_USAGE_SCHEMA = usage_schema(T.StringType())
ITEM_USAGE_BIGINT = usage_schema(T.LongType())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; Parquet scans prune columns and push filters on their own."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the cluster when its scan has fewer partitions than cores.

    A single unsplittable file (one Parquet row group) is read by one task; heavy per-row work on
    it (splitting whole texts into words) then runs on one core. Inputs already split into at least
    ``defaultParallelism`` partitions are returned unchanged, so large inputs pay no shuffle.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def read_parquet_dir(spark: SparkSession, path: str) -> DataFrame:
    """A directory of Parquet part files read as one table (pandas-concat of a glob, done by Spark)."""
    return spark.read.parquet(path)


def read_usage_csv(spark: SparkSession, path: str, schema: T.StructType = ITEM_USAGE_SCHEMA) -> DataFrame:
    """Headerless CSV directory with given column names and types (no inference pass).

    Item ids are strings unless the caller's schema says otherwise; a value that does not fit the schema
    stops the read instead of becoming null.
    """
    return spark.read.schema(schema).option("header", "false").option("mode", "FAILFAST").csv(path)


def read_jdbc(spark: SparkSession, url: str, table: str, columns: list[str], partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 1) -> DataFrame:
    """Relational table scan with the projection pushed into the database query.

    Needs the database's JDBC driver on the classpath. With ``partition_column`` and bounds, Spark
    issues ``partitions`` range queries in parallel instead of one scan.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"(SELECT {', '.join(columns)} FROM {table}) t")
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", partitions))
    return reader.load()
