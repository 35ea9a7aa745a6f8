"""Audits of a stored table. Dates come in as arguments; nothing here reads a clock."""

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions.calendar import run_days

# Team and player counts a sound game has, and the number of corrupted rows shown.
TEAMS_PER_GAME = 2
LEAST_PLAYERS_PER_TEAM = 5
LEAST_PLAYERS_PER_GAME = 10
SHOWN_ROWS = 20


def _day(value: date) -> Column:
    return F.lit(value).cast("date")


def between_days(df: DataFrame, first: date, last: date, day: str = "GAME_DATE") -> DataFrame:
    """A bare comparison on the date column, so that partitions are pruned."""
    return df.where(F.col(day).between(_day(first), _day(last)))


def daily_status(df: DataFrame, key: str = "ROW_KEY", day: str = "GAME_DATE") -> DataFrame:
    """Rows, distinct row keys and repeats per date, in date order."""
    counted = df.groupBy(day).agg(
        F.count(F.lit(1)).alias("total_rows"), F.countDistinct(key).alias("distinct_row_keys")
    )
    return counted.withColumn(
        "duplicate_row_keys", F.col("total_rows") - F.col("distinct_row_keys")
    ).orderBy(day)


def days_with_duplicates(status: DataFrame) -> DataFrame:
    return status.where("duplicate_row_keys > 0")


def missing_days(
    df: DataFrame, first: date, last: date, excluded: Iterable[date] = (), day: str = "GAME_DATE"
) -> DataFrame:
    """Calendar days without a row that are not excluded."""
    present = between_days(df, first, last, day).select(day).distinct()
    return run_days(df.sparkSession, first, last, excluded, day).join(present, day, "left_anti")


def games_without_two_teams(
    df: DataFrame, game: str = "GAME_ID", team: str = "PLAYER_TEAM_ID"
) -> DataFrame:
    teams = df.groupBy(game).agg(F.countDistinct(team).alias("team_count"))
    return teams.where(F.col("team_count") != TEAMS_PER_GAME)


def teams_with_few_players(
    df: DataFrame,
    game: str = "GAME_ID",
    team: str = "PLAYER_TEAM_ID",
    player: str = "PLAYER_ID",
    least: int = LEAST_PLAYERS_PER_TEAM,
) -> DataFrame:
    players = df.groupBy(game, team).agg(F.countDistinct(player).alias("player_count"))
    return players.where(F.col("player_count") < least)


def games_with_few_players(
    df: DataFrame, game: str = "GAME_ID", player: str = "PLAYER_ID", least: int = LEAST_PLAYERS_PER_GAME
) -> DataFrame:
    players = df.groupBy(game).agg(F.countDistinct(player).alias("total_players"))
    return players.where(F.col("total_players") < least)


def game_state(
    df: DataFrame,
    day: str = "GAME_DATE",
    game: str = "GAME_ID",
    team: str = "PLAYER_TEAM_ID",
    player: str = "PLAYER_ID",
    key: str = "ROW_KEY",
) -> DataFrame:
    """What the audits need of a stored table: a row per side of a game and one per game (whole_game), with its counts.

    A date's rows depend on that date alone, so the state is replaced with its partition and never recomputed for the others.
    A game id is a game of its date; one that is stored under several dates is one game on each.
    """
    counted = df.groupingSets([[day, game, team], [day, game]], day, game, team).agg(
        F.grouping(team).cast("boolean").alias("whole_game"),
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct(player).alias("players"),
        F.countDistinct(key).alias("row_keys"),
        F.countDistinct(team).alias("teams"),
    )
    return counted.select("whole_game", game, team, "total_rows", "players", "row_keys", "teams", day)


def daily_status_of(state: DataFrame, day: str = "GAME_DATE") -> DataFrame:
    """daily_status from the state; row keys hold their game, so no key is in two games of a date."""
    counted = state.where("whole_game").groupBy(day).agg(
        F.sum("total_rows").alias("total_rows"), F.sum("row_keys").alias("distinct_row_keys")
    )
    return counted.withColumn("duplicate_row_keys", F.col("total_rows") - F.col("distinct_row_keys")).orderBy(day)


def games_without_two_teams_of(state: DataFrame, game: str = "GAME_ID") -> DataFrame:
    games = state.where("whole_game").select(game, F.col("teams").alias("team_count"))
    return games.where(F.col("team_count") != TEAMS_PER_GAME)


def teams_with_few_players_of(
    state: DataFrame, game: str = "GAME_ID", team: str = "PLAYER_TEAM_ID", least: int = LEAST_PLAYERS_PER_TEAM
) -> DataFrame:
    sides = state.where("not whole_game").select(game, team, F.col("players").alias("player_count"))
    return sides.where(F.col("player_count") < least)


def games_with_few_players_of(state: DataFrame, game: str = "GAME_ID", least: int = LEAST_PLAYERS_PER_GAME) -> DataFrame:
    games = state.where("whole_game").select(game, F.col("players").alias("total_players"))
    return games.where(F.col("total_players") < least)


def corrupted_rows(
    df: DataFrame,
    keys: Sequence[str] = ("PLAYER_ID", "PLAYER_TEAM_ID", "GAME_ID"),
    order: Sequence[str] = ("ROW_KEY",),
    most: int = SHOWN_ROWS,
) -> DataFrame:
    """The first rows that lack a key; ordered, so that the report repeats."""
    broken = F.lit(False)
    for name in keys:
        broken = broken | F.col(name).isNull()
    return df.where(broken).orderBy(*order).limit(most)


def command_center(
    df: DataFrame,
    season_start: date,
    audit_end: date,
    day: str = "GAME_DATE",
    game: str = "GAME_ID",
    player: str = "PLAYER_ID",
) -> DataFrame:
    """Freshness and size of the table in one row and one scan.

    The last date has no upper bound; the other figures stop at the audit end.
    """
    inside = F.col(day) <= _day(audit_end)
    figures = df.where(F.col(day) >= _day(season_start)).agg(
        F.max(day).alias("last_game_date"),
        F.count(F.when(inside, F.lit(1))).alias("total_rows"),
        F.countDistinct(F.when(inside, F.col(game))).alias("total_games"),
        F.countDistinct(F.when(inside, F.col(player))).alias("unique_players"),
        F.countDistinct(F.when(inside, F.col(day))).alias("partition_count"),
    )
    return figures.select(
        "last_game_date",
        _day(audit_end).alias("expected_latest"),
        F.datediff(_day(audit_end), F.col("last_game_date")).alias("days_behind"),
        "total_rows",
        "total_games",
        "unique_players",
        "partition_count",
    )


def season_coverage(season: DataFrame, dimension: DataFrame, player: str = "PLAYER_ID") -> DataFrame:
    """Season and dimension sizes, and how many ids each lacks of the other, in one row.

    One full outer join of the two distinct id sets answers all of it.
    """
    wanted = season.select(player).dropna().distinct().withColumn("in_season", F.lit(1))
    known = dimension.select(player).dropna().distinct().withColumn("in_dimension", F.lit(1))
    both = wanted.join(known, player, "full_outer")
    return both.agg(
        F.count("in_season").alias("season_players"),
        F.count("in_dimension").alias("dimension_players"),
        F.count(F.when(F.col("in_dimension").isNull(), 1)).alias("missing_players"),
        F.count(F.when(F.col("in_season").isNull(), 1)).alias("extra_players"),
    )


def current_status(
    ledger: DataFrame, status: str = "STATUS", day: str = "GAME_DATE", run: str = "LOAD_BATCH_ID"
) -> DataFrame:
    """Per date the status of its latest run."""
    return ledger.groupBy(day).agg(F.max_by(status, run).alias(status), F.max(run).alias(run))


def ledger_snapshot(ledger: DataFrame, day: str = "GAME_DATE", run: str = "LOAD_BATCH_ID") -> DataFrame:
    """The ledger's row of the latest run of each date, whole."""
    others = [name for name in ledger.columns if name != day]
    latest = ledger.groupBy(day).agg(F.max_by(F.struct(*others), run).alias("last"))
    return latest.select(day, "last.*").select(*ledger.columns)


def run_summary(
    ledger: DataFrame, status: str = "STATUS", day: str = "GAME_DATE", run: str | None = None
) -> DataFrame:
    """Days per status, and per run if its column is named, with their sorted list.

    The list is bounded by the calendar days of the ledger. Without `run` a date counts under every status that it ever
    had; give `current_status` for the state of the store.
    """
    keys = [run, status] if run else [status]
    return ledger.select(*keys, day).distinct().groupBy(*keys).agg(
        F.count(day).alias("days"), F.sort_array(F.collect_list(F.col(day).cast("string"))).alias("day_list")
    )
