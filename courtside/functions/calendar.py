"""Run dates: text checks on the driver, the calendar itself as rows."""

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Date text format, zone of the schedule, days per run and per batch.
DATE_TEXT = "%m/%d/%Y"
SCHEDULE_ZONE = "America/New_York"
MAX_DAYS_PER_RUN = 7
DAYS_PER_BATCH = 7


def parse_day(text: str) -> date:
    try:
        return datetime.strptime(text, DATE_TEXT).date()
    except ValueError as error:
        raise ValueError(f"expected a date as MM/DD/YYYY, got {text!r}") from error


def parse_range(start: str, end: str, excluded: Iterable[str] = ()) -> tuple[date, date, list[date]]:
    first, last = parse_day(start), parse_day(end)
    if first > last:
        raise ValueError(f"start {start} lies after end {end}")
    return first, last, [parse_day(day) for day in excluded]


def calendar_days(bounds: DataFrame, start: Column, end: Column, name: str = "GAME_DATE") -> DataFrame:
    """Every day between two columns of a frame, both ends included."""
    return bounds.select(F.explode(F.sequence(start, end)).alias(name))


def without_days(days: DataFrame, excluded: Iterable[date], name: str = "GAME_DATE") -> DataFrame:
    listed = [F.lit(day).cast("date") for day in excluded]
    return days.where(~F.col(name).isin(*listed)) if listed else days


def run_days(
    spark: SparkSession, first: date, last: date, excluded: Iterable[date] = (), name: str = "GAME_DATE"
) -> DataFrame:
    """The inclusive run dates without the excluded ones."""
    days = calendar_days(
        spark.range(1), F.lit(first).cast("date"), F.lit(last).cast("date"), name
    )
    return without_days(days, excluded, name)


def days_between(first: date, last: date, excluded: Iterable[date] = ()) -> list[date]:
    """The run's dates on the driver; for short runs."""
    skipped = set(excluded)
    days = [first + timedelta(days=k) for k in range((last - first).days + 1)]
    return [day for day in days if day not in skipped]


def asked_days(first: Column, last: Column, excluded: Iterable[date] = ()) -> Column:
    """How many days a run from first to last asks for: both ends, less the excluded dates between them."""
    span = F.datediff(last, first) + 1
    for day in sorted(set(excluded)):
        span -= F.lit(day).cast("date").between(first, last).cast("int")
    return span


def check_day_cap(first: date, last: date, excluded: Iterable[date], most: int | None) -> None:
    """Refuse a run over too many days; None lifts the limit."""
    span = (last - first).days + 1
    skipped = {day for day in excluded if first <= day <= last}
    if most is not None and span - len(skipped) > most:
        raise ValueError(f"{span - len(skipped)} days asked for, at most {most} allowed in one run")


def number_batches(days: DataFrame, per_batch: int = DAYS_PER_BATCH, name: str = "GAME_DATE") -> DataFrame:
    """Number distinct days in order, and the batch each one falls in.

    The ordering window has no partition key. Its input is one row per calendar day after the
    distinct, so it is bounded by the length of the calendar and not by the table.
    """
    order = Window.orderBy(name)
    position = F.row_number().over(order) - 1
    return days.select(name).distinct().select(
        name,
        F.floor(position / per_batch).cast("int").alias("BATCH_NO"),
    )


def schedule_yesterday(utc: Column) -> Column:
    """The day before the Eastern date of a UTC wall-clock time, whatever the session zone is."""
    eastern = F.convert_timezone(F.lit("UTC"), F.lit(SCHEDULE_ZONE), utc.cast("timestamp_ntz"))
    return F.date_sub(F.to_date(eastern), 1)
