"""Scores per team and game, and the win flags on every row."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.functions import columns as C
from courtside.operators.joins import join_to_one

GAME = ("GAME_DATE", "GAME_ID")


def team_points(
    df: DataFrame, game: Sequence[str] = GAME, team: str = "PLAYER_TEAM_ID", points: str = "points"
) -> DataFrame:
    """Points per game and team; rows without a key are left out, an all-null sum is 0."""
    return (
        df.dropna(subset=[*game, team])
        .groupBy(*game, team)
        .agg(F.coalesce(F.try_sum(points), F.lit(0)).cast(df.schema[points].dataType).alias("TEAM_POINTS"))
    )


def game_scores(
    df: DataFrame,
    game: Sequence[str] = GAME,
    team: str = "PLAYER_TEAM_ID",
    points: str = "points",
    is_home: str = "HOME_FLAG",
) -> DataFrame:
    """One row per game with the home and away totals; a side that never played is null.

    A side is one team, so its total is the side's sum, and both sums come from one combined
    aggregation by game. Null points count as 0, which keeps a side without points apart from an
    absent side.
    """
    scored = F.coalesce(points, F.lit(0))
    return (
        df.dropna(subset=[*game, team, is_home])
        .groupBy(*game)
        .agg(
            F.try_sum(F.when(F.col(is_home), scored)).alias("HOME_POINTS"),
            F.try_sum(F.when(~F.col(is_home), scored)).alias("AWAY_POINTS"),
        )
    )


def game_flags(
    df: DataFrame,
    game: Sequence[str] = GAME,
    team: str = "PLAYER_TEAM_ID",
    points: str = "points",
    is_home: str = "HOME_FLAG",
) -> DataFrame:
    """One row per game with HOME_TEAM_WIN_FLAG."""
    scores = game_scores(df, game, team, points, is_home)
    return scores.select(
        *game, C.home_win(F.col("HOME_POINTS"), F.col("AWAY_POINTS")).alias("HOME_TEAM_WIN_FLAG")
    )


def with_win_flags(df: DataFrame, is_home: str = "HOME_FLAG") -> DataFrame:
    """The game's flag, false where the game has none, and the own team's flag next to it."""
    won = F.coalesce("HOME_TEAM_WIN_FLAG", F.lit(False))
    return df.withColumns(
        {"HOME_TEAM_WIN_FLAG": won, "PLAYER_TEAM_WIN_FLAG": C.own_team_win(F.col(is_home), won)}
    )


def with_outcome(
    df: DataFrame,
    game: Sequence[str] = GAME,
    team: str = "PLAYER_TEAM_ID",
    points: str = "points",
    is_home: str = "HOME_FLAG",
) -> DataFrame:
    """Every row with HOME_TEAM_WIN_FLAG and PLAYER_TEAM_WIN_FLAG, from summed player points.

    Only the one flag per game travels back to the rows. A window over the game would put a whole
    game in one task; the aggregate and the join do not.
    """
    flags = game_flags(df, game, team, points, is_home)
    return with_win_flags(join_to_one(df, flags, game), is_home)
