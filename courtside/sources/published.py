"""A date-partitioned table in Spark's catalog whose partitions are swapped to audited versions.

Rows are written to a version folder that no reader sees, counted there, and only then the partitions of the dates
that pass are pointed at it, each in one catalog operation. So a date is served either as it was or as it was audited, also if
the job ends in between. What the catalog keeps lasts as long as the catalog: a session's own or a metastore's.
"""

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.operators.gates import row_count_check
from courtside.session import discard, subfolders

# So many partitions are added in one statement.
PARTITIONS_PER_STATEMENT = 500


@dataclass(frozen=True)
class PublishedTable:
    """`table` in the catalog, its versions below `root`."""

    spark: SparkSession
    table: str
    root: str
    schema: T.StructType
    day: str = "GAME_DATE"

    def create(self) -> None:
        if not self.spark.catalog.tableExists(self.table):
            self.spark.sql(
                f"CREATE TABLE {self.table} ({self.schema.toDDL()}) USING parquet PARTITIONED BY ({self.day}) "
                f"LOCATION {_quoted(f'{self.root}/table')}"
            )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table).select(*self.schema.names)

    def stage(self, rows: DataFrame, version: str) -> str:
        """Writes a version that nothing points at yet; its folder."""
        folder = f"{self.root}/versions/{version}-{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.option("compression", "zstd").partitionBy(self.day).parquet(folder)
        return folder

    def audit(self, folder: str, expected: DataFrame) -> DataFrame:
        """Expected (day, rows) against the rows that the version really holds, per date."""
        return row_count_check(expected, self.spark.read.schema(self.schema).parquet(folder), self.day)

    def swap(self, folder: str, days: Iterable[date]) -> None:
        """Points the dates at the version; dates it does not name stay where they are."""
        known = {row[0].split("=", 1)[1] for row in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()}
        fresh = []
        for value in sorted(days):
            place = f"PARTITION ({self.day}=DATE'{value}')"
            location = f"LOCATION {_quoted(f'{folder}/{self.day}={value}')}"
            if str(value) in known:
                self.spark.sql(f"ALTER TABLE {self.table} {place} SET {location}")
            else:
                fresh.append(f"{place} {location}")
        for at in range(0, len(fresh), PARTITIONS_PER_STATEMENT):
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {' '.join(fresh[at : at + PARTITIONS_PER_STATEMENT])}")

    def publish(self, rows: DataFrame, expected: DataFrame, version: str) -> DataFrame:
        """Write, audit, publish. Per expected date: expected_rows, stored_rows and pass; the others keep their old rows.

        The report is collected, one row per calendar day of the run, because the swap is the driver's.
        """
        folder = self.stage(rows, version)
        report = self.audit(folder, expected)
        found = report.collect()
        self.swap(folder, [row[self.day] for row in found if row["pass"] and row["stored_rows"]])
        return self.spark.createDataFrame(found, report.schema)

    def _served(self) -> set[tuple[str, ...]]:
        """(version, date folder) that dates point at. A version's name is unique, so how a store spells the path before it is no matter."""
        return {tuple(file.split("/")[-3:-1]) for file in self.rows().inputFiles()}

    def unserved(self) -> Iterator[str]:
        """Folders of dates in versions that no partition points at any more."""
        served = self._served()
        for version in subfolders(self.spark, f"{self.root}/versions"):
            for folder in subfolders(self.spark, version, f"{self.day}="):
                if tuple(folder.split("/")[-2:]) not in served:
                    yield folder

    def retire(self) -> int:
        """Deletes the folders of dates that were replaced or failed; no reader of an older state may be running."""
        gone = list(self.unserved())
        for folder in gone:
            discard(self.spark, folder)
        return len(gone)


def _quoted(text: str) -> str:
    """A text as a literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def expected_counts(rows: DataFrame, day: str = "GAME_DATE") -> DataFrame:
    """Rows per date, in the form that an audit expects."""
    return rows.groupBy(day).agg(F.count(F.lit(1)).alias("rows"))
