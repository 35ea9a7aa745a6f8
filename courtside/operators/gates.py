"""Quality gates as one report: a row per date and gate, with the number of bad rows."""

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.functions.calendar import DAYS_PER_BATCH
from courtside.functions.columns import is_missing

REQUIRED = ("ROW_KEY", "PLAYER_ID", "minutes_SECONDS")
ROW_GATES = ["duplicate_row_key", "null_player_id", "negative_minutes", "empty", "null_values"]


def check_columns(names: Sequence[str], required: Sequence[str] = REQUIRED) -> None:
    """Required columns are there and no name occurs twice."""
    missing = [name for name in required if name not in names]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    repeated = sorted({name for name in names if list(names).count(name) > 1})
    if repeated:
        raise ValueError(f"duplicate column names: {repeated}")


def column_report(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """What check_columns would refuse, in rows: column_name, problem ("missing" or "duplicate") and times it occurs."""
    names = df.columns
    found = [(name, "missing", 0) for name in required if name not in names]
    found += [(name, "duplicate", names.count(name)) for name in sorted(set(names)) if names.count(name) > 1]
    return df.sparkSession.createDataFrame(found, "column_name string, problem string, times int")


def _missing(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    return is_missing(F.col(name), isinstance(kind, (T.DoubleType, T.FloatType)))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, all columns counted in one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(
        *[F.coalesce(F.sum(_missing(df, c).cast("bigint")), F.lit(0)).alias(c) for c in columns]
    )
    return counted.unpivot([], columns, "column_name", "null_rows")


def null_profile_by_day(df: DataFrame, day: str = "GAME_DATE") -> DataFrame:
    """Per date the columns that have missing values, with their number, all columns counted in one pass."""
    columns = [c for c in df.columns if c != day]
    counted = df.groupBy(day).agg(*[F.sum(_missing(df, c).cast("bigint")).alias(c) for c in columns])
    return counted.unpivot([day], columns, "column_name", "null_rows").where("null_rows > 0")


def null_cells(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Per row, how many of its columns are missing."""
    return reduce(Column.__add__, (_missing(df, c).cast("bigint") for c in (columns or df.columns)))


def day_counts(
    df: DataFrame,
    day: str = "GAME_DATE",
    key: str = "ROW_KEY",
    player: str = "PLAYER_ID",
    seconds: str = "minutes_SECONDS",
    counted_nulls: str | None = None,
) -> DataFrame:
    """Per date: rows and the bad rows of each gate, from one scan.

    `counted_nulls` names a column that already holds null_cells. With it the scan reads five narrow
    columns; without it, all of them.

    Grouping by date and row key first counts the repeats and carries the other sums along, so
    the wide rows never move and a date with a third of the table is spread over its keys.
    """
    nulls = F.col(counted_nulls) if counted_nulls else null_cells(df)
    per_key = df.groupBy(day, key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(player).isNull().cast("bigint")).alias("no_player"),
        F.sum(F.coalesce(F.col(seconds) < 0, F.lit(False)).cast("bigint")).alias("negative"),
        F.sum(nulls).alias("nulls"),
    )
    return per_key.groupBy(day).agg(
        F.sum("n").alias("rows"),
        F.sum(F.col("n") - 1).alias("duplicate_row_key"),
        F.sum("no_player").alias("null_player_id"),
        F.sum("negative").alias("negative_minutes"),
        F.sum("nulls").alias("null_values"),
    )


class ObservedDays:
    """The counts of day_counts as metrics of the job that writes the rows, for a bounded list of dates.

    Each observation holds `per` dates. Repeated keys cannot be observed; `counts` takes them from a narrow frame of the keys.
    """

    def __init__(self, days: Sequence[date], per: int = DAYS_PER_BATCH):
        self.batches = [(Observation(), list(days[at : at + per])) for at in range(0, len(days), per)]

    def watch(
        self, df: DataFrame, nulls: Column, day: str = "GAME_DATE", player: str = "PLAYER_ID", seconds: str = "minutes_SECONDS"
    ) -> DataFrame:
        """The same rows, counted on their way; nothing is counted until an action has run through them."""
        for observation, days in self.batches:
            metrics = []
            for value in days:
                here = F.col(day) == F.lit(value).cast("date")
                metrics += [
                    F.count(F.when(here, 1)).alias(f"{value}|rows"),
                    F.count(F.when(here & F.col(player).isNull(), 1)).alias(f"{value}|null_player_id"),
                    F.count(F.when(here & (F.col(seconds) < 0), 1)).alias(f"{value}|negative_minutes"),
                    F.sum(F.when(here, nulls)).alias(f"{value}|null_values"),
                ]
            df = df.observe(observation, *metrics)
        return df

    def counts(self, spark: SparkSession, keys: DataFrame, day: str = "GAME_DATE", key: str = "ROW_KEY") -> DataFrame:
        """In the form of day_counts; waits for the watched action."""
        names = ["rows", "null_player_id", "negative_minutes", "null_values"]
        found = [
            (value, *(observation.get[f"{value}|{name}"] or 0 for name in names)) for observation, days in self.batches for value in days
        ]
        seen = spark.createDataFrame(found, f"`{day}` date, " + ", ".join(f"{name} bigint" for name in names)).where("rows > 0")
        per_key = keys.groupBy(day, key).agg((F.count(F.lit(1)) - 1).alias("n"))
        repeats = per_key.groupBy(day).agg(F.sum("n").alias("duplicate_row_key"))
        return seen.join(repeats, day, "left").fillna(0, ["duplicate_row_key"])


def gate_report(counts: DataFrame, days: DataFrame | None = None, day: str = "GAME_DATE") -> DataFrame:
    """Long form of day_counts; a date of `days` without any row fails the gate for empty frames."""
    if days is not None:
        counts = days.select(day).distinct().join(counts, day, "left")
    filled = counts.fillna(0).withColumn("empty", (F.col("rows") == 0).cast("bigint"))
    return long_report(filled, ROW_GATES, day)


def long_report(wide: DataFrame, gates: Sequence[str], day: str = "GAME_DATE") -> DataFrame:
    return wide.unpivot([day], list(gates), "gate", "bad_rows").withColumn(
        "pass", F.col("bad_rows") == 0
    )


def duplicate_examples(df: DataFrame, key: str = "ROW_KEY", most: int = 5) -> DataFrame:
    """The first repeated keys in key order, with how often each occurs."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows")).where("key_rows > 1")
    return repeated.orderBy(key).limit(most)


def row_count_check(expected: DataFrame, stored: DataFrame, day: str = "GAME_DATE") -> DataFrame:
    """Expected against stored rows per date, for all dates at once."""
    counted = stored.groupBy(day).agg(F.count(F.lit(1)).alias("stored_rows"))
    return expected.join(counted, day, "left").select(
        day,
        F.col("rows").alias("expected_rows"),
        F.coalesce("stored_rows", F.lit(0)).alias("stored_rows"),
        (F.col("rows") == F.coalesce("stored_rows", F.lit(0))).alias("pass"),
    )
