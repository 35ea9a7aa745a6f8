"""The stored tables: the date-partitioned player-game log, two dimensions and the load ledger."""

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside import schema as S
from courtside.operators.audits import ledger_snapshot
from courtside.operators.gates import row_count_check
from courtside.session import exists, subfolders
from courtside.sources.arenas import arena_rows
from courtside.sources.published import PublishedTable

# A day's rows go to files of about this many rows each.
ROWS_PER_FILE = 2_000_000
# So many dates of 12 bytes each are broadcast at most: 1.2 MB, which are 273 years.
BROADCAST_DAYS = 100_000


def table_exists(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    try:
        spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def spread_days(
    df: DataFrame,
    counts: DataFrame,
    day: str = "GAME_DATE",
    key: str = "ROW_KEY",
    order: tuple[str, ...] = ("PLAYER_ID", "PLAYER_TEAM_ID"),
    rows_per_file: int = ROWS_PER_FILE,
) -> DataFrame:
    """Rows laid out for a write by date, a large date split over as many files as its rows need.

    `counts` has one row per date to write (day, rows); dates it lacks are dropped. Without the split
    a date with a third of the table would be one task and one file. The slot comes from `key`, which
    should be close to unique. Sorting inside a file by player and team keeps its min/max statistics
    narrow for readers.
    """
    files = counts.select(
        day, F.greatest(F.lit(1), F.ceil(F.col("rows") / rows_per_file)).cast("int").alias("file_slots")
    )
    size = counts.agg(F.count(day).alias("days"), F.sum("rows").alias("rows")).first()
    placed = df.join(F.broadcast(files) if size["days"] <= BROADCAST_DAYS else files, day)
    slot = F.pmod(F.xxhash64(key), F.col("file_slots"))
    # A task writes one file after the other, so small dates share tasks.
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, 2 * (size["rows"] or 0) // rows_per_file)
    return (
        placed.withColumn("file_slot", slot)
        .repartition(tasks, day, "file_slot")
        .sortWithinPartitions(day, *order)
        .drop("file_slots", "file_slot")
    )


@dataclass(frozen=True)
class Store:
    """Tables below one root folder that all executors can reach.

    With `log_table` the log is that table of Spark's catalog, and dates are published after their audit. Without it the log is a plain
    folder, in which a date is replaced first and counted then.
    """

    spark: SparkSession
    root: str
    log_table: str | None = None

    @property
    def published(self) -> PublishedTable | None:
        return PublishedTable(self.spark, self.log_table, self.log_path, S.PLAYER_GAME) if self.log_table else None

    @property
    def published_state(self) -> PublishedTable | None:
        return PublishedTable(self.spark, f"{self.log_table}_state", self.state_path, S.GAME_STATE) if self.log_table else None

    @property
    def log_path(self) -> str:
        return f"{self.root}/player_game_log"

    @property
    def state_path(self) -> str:
        return f"{self.root}/game_state"

    @property
    def snapshot_path(self) -> str:
        return f"{self.root}/ledger_snapshot"

    @property
    def players_path(self) -> str:
        return f"{self.root}/player_dimension"

    @property
    def arenas_path(self) -> str:
        return f"{self.root}/arena_dimension"

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/load_ledger"

    def _create(self, path: str, schema: T.StructType, by: str | None = None) -> None:
        if not table_exists(self.spark, path, schema):
            writer = self.spark.createDataFrame([], schema).write
            (writer.partitionBy(by) if by else writer).parquet(path)

    def create_log(self) -> None:
        if self.published:
            self.published.create()
            self.published_state.create()
        else:
            self._create(self.log_path, S.PLAYER_GAME, "GAME_DATE")
            self._create(self.state_path, S.GAME_STATE, "GAME_DATE")

    def create_players(self) -> None:
        self._create(self.players_path, S.PLAYER_DIMENSION)

    def create_arenas(self) -> None:
        self._create(self.arenas_path, S.ARENA_DIMENSION)

    def log(self) -> DataFrame:
        if self.published:
            return self.published.rows()
        return self.spark.read.schema(S.PLAYER_GAME).parquet(self.log_path).select(*S.PLAYER_GAME.names)

    def players(self) -> DataFrame:
        stored = self.spark.read.schema(S.PLAYER_DIMENSION).parquet(self.players_path)
        return stored.select("PLAYER_ID", "POSITION", "HEIGHT", "EXP")

    def arenas(self, updated_at: datetime) -> DataFrame:
        """The arena dimension, built on the spot when it does not exist yet."""
        if not table_exists(self.spark, self.arenas_path, S.ARENA_DIMENSION):
            self.replace_arenas(arena_rows(self.spark, updated_at))
        stored = self.spark.read.schema(S.ARENA_DIMENSION).parquet(self.arenas_path)
        return stored.select("TEAM_ID", "TEAM_TRICODE", "ARENA_NAME", "ARENA_CITY", "ARENA_STATE")

    @property
    def rejects_path(self) -> str:
        return f"{self.root}/rejected_lines"

    def rejects(self) -> DataFrame:
        """The lines that loads have rejected, with the load's id."""
        return self.spark.read.schema(S.REJECTS).parquet(self.rejects_path)

    def append_rejects(self, rows: DataFrame, batch: str) -> None:
        kept = rows.withColumn("LOAD_BATCH_ID", F.lit(batch)).select(*S.REJECTS.names)
        kept.write.mode("append").parquet(self.rejects_path)

    def ledger(self) -> DataFrame:
        """A row per run and date, in a folder per run."""
        return self.spark.read.schema(S.LEDGER).parquet(self.ledger_path).select(*S.LEDGER.names)

    def compact_ledger(self) -> None:
        """Writes the current state of each date as a snapshot, from the last snapshot and the runs after it.

        The runs stay where they are, for `run_summary`. A snapshot is a folder named after the last run it has; one that
        was cut off lacks its mark of success and is not read.
        """
        runs = self._runs()
        if runs:
            replace_all(self.current_ledger(), f"{self.snapshot_path}/{runs[-1]}")

    def _runs(self) -> list[str]:
        return [folder.rsplit("=", 1)[1] for folder in subfolders(self.spark, self.ledger_path, "LOAD_BATCH_ID=")]

    def _snapshot(self) -> str | None:
        """The last run of the latest whole snapshot."""
        whole = [f for f in subfolders(self.spark, self.snapshot_path) if exists(self.spark, f"{f}/_SUCCESS")]
        return whole[-1].rsplit("/", 1)[1] if whole else None

    def current_ledger(self) -> DataFrame:
        """The row of the latest run of each date. Only the snapshot and the runs from its last one on are read."""
        upto, ledger = self._snapshot(), self.ledger()
        if upto is None:
            return ledger_snapshot(ledger)
        kept = self.spark.read.schema(S.LEDGER).parquet(f"{self.snapshot_path}/{upto}").select(*S.LEDGER.names)
        # The last run of the snapshot may have been repeated since.
        return ledger_snapshot(kept.unionByName(ledger.where(F.col("LOAD_BATCH_ID") >= upto)))

    def replace_days(self, rows: DataFrame) -> None:
        """Overwrite the dates present in `rows` and leave every other date alone."""
        replace_days(rows, self.log_path)

    def publish_days(self, rows: DataFrame, expected: DataFrame, version: str) -> DataFrame:
        """Replace the expected dates (GAME_DATE, rows); the report of expected against stored rows."""
        laid_out = spread_days(rows, expected)
        if self.published:
            return self.published.publish(laid_out, expected, version)
        self.replace_days(laid_out)
        first, last = expected.agg(F.min("GAME_DATE"), F.max("GAME_DATE")).first()
        stored = self.log().where(F.col("GAME_DATE").between(F.lit(first), F.lit(last)))
        return row_count_check(expected, stored)

    def state(self) -> DataFrame:
        """The audit state of the log: what `audits.game_state` gives, kept up with the dates that are published."""
        if self.published_state:
            return self.published_state.rows()
        return self.spark.read.schema(S.GAME_STATE).parquet(self.state_path).select(*S.GAME_STATE.names)

    def publish_state(self, state: DataFrame, version: str) -> None:
        """Replace the state of its dates; a few rows a game, so a date is one file."""
        dealt = state.repartition(self.spark.sparkContext.defaultParallelism, "GAME_DATE").sortWithinPartitions("GAME_DATE")
        if self.published_state:
            table = self.published_state
            folder = table.stage(dealt, version)
            table.swap(folder, [date.fromisoformat(f.rsplit("=", 1)[1]) for f in subfolders(self.spark, folder, "GAME_DATE=")])
        else:
            replace_days(dealt, self.state_path)

    def append_players(self, rows: DataFrame, updated_at: datetime) -> None:
        """Add the ids that are not stored yet; the caller's rows hold each id once."""
        append_missing(
            rows.withColumn("LAST_UPDATED_UTC", F.lit(updated_at)), self.players_path, S.PLAYER_DIMENSION, "PLAYER_ID"
        )

    def replace_arenas(self, rows: DataFrame) -> None:
        replace_all(rows.select(*S.ARENA_DIMENSION.names), self.arenas_path)

    def append_ledger(self, rows: DataFrame) -> None:
        rows.select(*S.LEDGER.names).write.mode("append").partitionBy("LOAD_BATCH_ID").parquet(self.ledger_path)


def replace_days(rows: DataFrame, path: str, day: str = "GAME_DATE") -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(day)
        .parquet(path)
    )


def append_missing(rows: DataFrame, path: str, schema: T.StructType, key: str) -> None:
    """Append the rows whose key the table lacks."""
    known = rows.sparkSession.read.schema(schema).parquet(path).select(key)
    rows.join(known, key, "left_anti").select(*schema.names).write.mode("append").parquet(path)


def replace_all(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


#: Settings under which a folder of parquet files answers counts from its footers.
_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_counts(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] = (), day: str = "GAME_DATE"
) -> DataFrame:
    """Per date of a date-partitioned folder: rows, and the nulls of the columns, from the files' footers; no row is read.

    Done at once, because the settings that push the counts down hold while it runs; one row per stored date comes to the driver.
    NaN is no null here, unlike in the null gate.
    """
    counted = [F.count(F.lit(1)).alias("rows"), *(F.count(F.col(c)).alias(f"n{k}") for k, c in enumerate(columns))]
    shown = ["rows", *((F.col("rows") - F.col(f"n{k}")).alias(c) for k, c in enumerate(columns))]
    before = {name: spark.conf.get(name) for name in _FOOTERS}
    try:
        for name, value in _FOOTERS.items():
            spark.conf.set(name, value)
        # Spark pushes grouping by a partition column down only under its lower-case name.
        lower = T.StructType([T.StructField(f.name.lower() if f.name == day else f.name, f.dataType) for f in schema])
        per_day = spark.read.schema(lower).parquet(path).groupBy(day.lower()).agg(*counted)
        if "PushedAggregation: [COUNT" not in per_day._jdf.queryExecution().executedPlan().toString():
            raise RuntimeError("these counts are not answered from the footers")
        found = per_day.select(F.col(day.lower()).alias(day), *shown)
        rows, kinds = found.collect(), found.schema
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return spark.createDataFrame(rows, kinds)
