"""Scalar derivations, Column in and Column out; all of them run inside whole-stage codegen."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text used for an absent playing time, the separator of row keys, the batch-id format.
NO_MINUTES = "0:00"
KEY_SEPARATOR = "_"
BATCH_ID_FORMAT = "%Y%m%d%H%M%S"

_MINUTES_TEXT = r"^\s*[+-]?\d+\s*:\s*[+-]?\d+\s*$"
# What a cast to a whole number refuses wherever it stands: all but digits, signs and what the cast trims.
_NO_WHOLE_NUMBER = r"[^0-9+\-\x00-\x20\x7f]"
_NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def player_name(display: Column, first: Column, family: Column) -> Column:
    """The display name, else "first family" when both are there, else null; empty text counts as absent."""
    return F.when(F.length(display) > 0, display).when(
        (F.length(first) > 0) & (F.length(family) > 0), F.concat_ws(" ", first, family)
    )


def to_number(value: Column) -> Column:
    """Text as a double; what is not a plain number becomes null."""
    text = value.cast("string")
    return F.when(text.rlike(_NUMBER_TEXT), text.try_cast("double"))


def to_id(value: Column) -> Column:
    """Text as a whole number ("12" and "12.0"); fractions and anything else become null.

    The direct cast comes first, so ids beyond 2^53 keep every digit. Text that it would refuse is kept from it, as each refusal is an
    exception that Spark throws and catches, which takes far longer than the cast.
    """
    number, text = to_number(value), value.cast("string")
    return F.coalesce(
        F.when(~text.rlike(_NO_WHOLE_NUMBER), text.try_cast("bigint")),
        F.when(number == F.floor(number), number.try_cast("bigint")),
    )


def minutes_text(value: Column) -> Column:
    """Playing time with null and empty text replaced by "0:00"."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(NO_MINUTES))


def minutes_to_seconds(value: Column) -> Column:
    """"MM:SS" as seconds; null, malformed text and times beyond 64 bits give 0, signs are kept ("-1:30" is -30)."""
    parts = F.split(value, ":")
    minutes = F.get(parts, F.lit(0)).try_cast("bigint")
    seconds = F.get(parts, F.lit(1)).try_cast("bigint")
    return F.when(
        value.rlike(_MINUTES_TEXT), F.coalesce(F.try_add(F.try_multiply(minutes, F.lit(60)), seconds), F.lit(0).cast("bigint"))
    ).otherwise(F.lit(0).cast("bigint"))


def did_not_play(seconds: Column) -> Column:
    return seconds == 0


def played(seconds: Column) -> Column:
    return seconds > 0


def home_flag(team_id: Column, home_team_id: Column) -> Column:
    return team_id == home_team_id


def signed_margin(is_home: Column, home_points: Column, away_points: Column) -> Column:
    """Home minus away, seen from the row's own side; null beyond 64 bits."""
    return F.when(~is_home, F.try_subtract(away_points, home_points)).otherwise(F.try_subtract(home_points, away_points))


def game_total(home_points: Column, away_points: Column) -> Column:
    return F.try_add(home_points, away_points)


def home_win(home_points: Column, away_points: Column) -> Column:
    """A tie or a missing side counts as no home win."""
    return F.coalesce(home_points > away_points, F.lit(False))


def own_team_win(is_home: Column, home_won: Column) -> Column:
    """So a tie marks the away side as the winner."""
    return is_home == home_won


def official(officials: Column, position: int, field: str) -> Column:
    """A field of the official at a position counted from 0; a short list gives null."""
    return F.get(officials, F.lit(position)).getField(field)


def row_key(game_id: Column, player_id: Column) -> Column:
    """Null when either part is null, unlike a plain concat_ws."""
    return F.concat(
        game_id.cast("string"), F.lit(KEY_SEPARATOR), player_id.cast("string")
    )


def batch_id(moment: datetime) -> str:
    """One id for a whole run, made on the driver so that re-run tasks agree."""
    return moment.strftime(BATCH_ID_FORMAT)


def is_missing(value: Column, is_float: bool) -> Column:
    """Null, or NaN in a float column."""
    return (value.isNull() | F.isnan(value)) if is_float else value.isNull()
