"""Batch scans of the valid and fraud lakes (partitioned Parquet)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ledgerguard.schema import ALERT_SCHEMA, TRANSACTION_SCHEMA
from ledgerguard.session import path_exists
from ledgerguard.sinks.commits import Visible, visible

NOTHING = Visible(frozenset(), {}, {})

VALID_LAKE_SCHEMA = StructType(TRANSACTION_SCHEMA.fields + [StructField("date", DateType(), True)])
FRAUD_LAKE_SCHEMA = StructType(ALERT_SCHEMA.fields + [StructField("date", DateType(), True)])


def read_parquet_or_empty(spark: SparkSession, path: str, schema: StructType | None = None,
                          below: str = "") -> DataFrame:
    """Partition-discovering Parquet scan that reads an absent folder, or one
    without data files yet (e.g. a sink that has emitted nothing), as empty.

    Spark's reader skips ``_``-prefixed paths, so files of an unfinished write
    (``_temporary``) are never counted.
    """
    empty = spark.createDataFrame([], schema) if schema is not None else None
    part = f"{path}/{below}" if below else path
    if not path_exists(spark, part):
        if empty is None:
            raise FileNotFoundError(path)
        return empty
    try:
        return spark.read.option("basePath", path).parquet(part)
    except AnalysisException as e:
        if empty is None or "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise  # data that cannot be read is not an empty lake
        return empty


def read_lake(spark: SparkSession, path: str, schema: StructType, day: str | None = None) -> DataFrame:
    """The committed rows of a lake; absent or still empty lakes read as empty.

    Filters on ``date`` prune partitions; ``day`` ('yyyy-MM-dd') lists that
    day's folder alone. A folder without attempts, such as another tool's
    partitioned Parquet, is read whole.
    """
    shown = visible(spark, path, day)  # before the files are listed
    df = read_parquet_or_empty(spark, path, schema, f"date={day}" if day else "")
    if "date" in df.columns:
        # Partition discovery may type an all-default lake's date as string.
        df = df.withColumn("date", df["date"].cast("date"))
    if "attempt" in df.columns:
        df = (shown or NOTHING).of(df.withColumn("attempt", df["attempt"].cast("string")))
    return df


def read_committed(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The committed rows of a table of attempts without dates: alerts, quarantine, metrics."""
    shown = visible(spark, path)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    full = StructType(schema.fields + [StructField("attempt", StringType(), True)])
    return (shown or NOTHING).of(spark.read.schema(full).format(fmt).load(path))


def read_valid_lake(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    return read_lake(spark, path, VALID_LAKE_SCHEMA, day)


def read_fraud_lake(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    return read_lake(spark, path, FRAUD_LAKE_SCHEMA, day)
