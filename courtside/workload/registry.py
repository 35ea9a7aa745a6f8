"""Registered queries over the given tables, each with the SQL it must agree with."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt out evenly if they lie in fewer pieces than tasks can run, for work that costs far more than moving them."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


def plain(df: DataFrame) -> DataFrame:
    """Lower-case names, dates and UTC timestamps as text: the same on both engines."""
    shown = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            value = F.to_utc_timestamp(value, F.current_timezone()).cast("string")
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            value = value.cast("string")
        shown.append(value.alias(field.name.lower()))
    return df.select(*shown)
