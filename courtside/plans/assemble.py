"""From flat endpoint rows to player-game rows.

Each `with_*` step works alone on any player rows. `assemble` composes them with fewer moves of
the wide rows: everything known per game and team is put together on small frames first and
joined to the player rows once.
"""

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.functions import columns as C
from courtside.operators import outcome, payloads
from courtside.operators.joins import guarded_join, require_unique
from courtside.operators.gates import check_columns
from courtside.operators.shape import fill_missing, lock_schema

GAME = list(outcome.GAME)
GAME_TEAM = [*GAME, "PLAYER_TEAM_ID"]


def player_table(
    traditional: DataFrame, advanced: DataFrame, usage: DataFrame, checked: bool = False
) -> DataFrame:
    """Traditional rows with the advanced and usage columns under their suffixes.

    All three are unique by game, player and team, so the joins share one partitioning and no key
    can be hot. `checked` says that the caller has already shown this.
    """
    keys = payloads.STAT_KEYS
    if not checked:
        for name, rows in (("traditional", traditional), ("advanced", advanced), ("usage", usage)):
            require_unique(rows, keys, name)
    return payloads.as_player_team(_box_scores(traditional, advanced, usage))


def _box_scores(traditional: DataFrame, advanced: DataFrame, usage: DataFrame) -> DataFrame:
    keys = payloads.STAT_KEYS
    table = traditional.join(payloads.suffixed(advanced, "_ADV"), keys, "left").join(
        payloads.suffixed(usage, "_USAGE"), keys, "left"
    )
    check_columns(table.columns, required=keys)
    return table


def with_team_context(players: DataFrame, team_factors: DataFrame) -> DataFrame:
    return guarded_join(players, team_factors, GAME_TEAM, "m:1")


def _home_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("HOME_FLAG", C.home_flag(F.col("PLAYER_TEAM_ID"), F.col("HOME_TEAM_ID")))


def _game_facts(df: DataFrame) -> DataFrame:
    """Home flag, own-side margin and total from the joined game columns."""
    home, away = F.col("HOME_TEAM_POINTS"), F.col("AWAY_TEAM_POINTS")
    return _home_flag(df).withColumns(
        {
            "POINT_MARGIN": C.signed_margin(F.col("HOME_FLAG"), home, away),
            "GAME_TOTAL_POINTS": C.game_total(home, away),
        }
    )


def with_game_metadata(players: DataFrame, live_games: DataFrame) -> DataFrame:
    return _game_facts(guarded_join(players, live_games, GAME, "m:1"))


def with_outcome(players: DataFrame) -> DataFrame:
    return outcome.with_outcome(players)


def with_dimensions(players: DataFrame, player_dimension: DataFrame, arenas: DataFrame) -> DataFrame:
    """Player attributes by player id, venue by the home team; the arena's own team columns stay out."""
    venues = arenas.withColumnRenamed("TEAM_ID", "HOME_TEAM_ID").drop("TEAM_TRICODE")
    known = guarded_join(players, player_dimension, ["PLAYER_ID"])
    return guarded_join(known, venues, ["HOME_TEAM_ID"])


def unmatched_players(players: DataFrame, player_dimension: DataFrame) -> DataFrame:
    """Distinct player ids that the dimension lacks."""
    wanted = players.select("PLAYER_ID").dropna().distinct()
    return wanted.join(player_dimension.select("PLAYER_ID"), "PLAYER_ID", "left_anti")


def team_game_context(
    traditional: DataFrame, team_factors: DataFrame, live_games: DataFrame
) -> DataFrame:
    """One row per game and team: four factors, game facts, side, margin and win flags."""
    teams = outcome.team_points(payloads.as_player_team(traditional))
    sided = _home_flag(teams.join(live_games.select(*GAME, "HOME_TEAM_ID"), GAME, "left"))
    games = live_games.join(outcome.game_flags(sided, points="TEAM_POINTS"), GAME, "left")
    facts = teams.drop("TEAM_POINTS").join(team_factors, GAME_TEAM, "left").join(games, GAME, "left")
    return outcome.with_win_flags(_game_facts(facts))


def assemble(
    traditional: DataFrame,
    advanced: DataFrame,
    usage: DataFrame,
    team_factors: DataFrame,
    live_games: DataFrame,
) -> DataFrame:
    """Player rows of all games at once, for inputs whose keys were found unique.

    Equal to player_table, with_team_context, with_game_metadata and with_outcome in a row for rows that
    have all their keys (others fail their date). The context of a game and team is brought to the grain of
    the box scores on the key columns alone; it is then one more side of the join that the box scores share, so
    the wide rows move once.
    """
    keys = payloads.STAT_KEYS
    context = team_game_context(traditional, team_factors, live_games)
    own = traditional.select(*keys).withColumnRenamed("TEAM_ID", "PLAYER_TEAM_ID")
    sides = own.join(context, GAME_TEAM, "left").withColumnRenamed("PLAYER_TEAM_ID", "TEAM_ID")
    wide = _box_scores(traditional, advanced, usage).join(sides, keys, "left")
    return payloads.as_player_team(wide)


def finished(players: DataFrame, ingested_at: datetime) -> DataFrame:
    """Participation, lineage and row key, locked to the stored schema."""
    seconds = C.minutes_to_seconds(F.col("minutes"))
    timed = players.withColumn("minutes", C.minutes_text(F.col("minutes"))).withColumn(
        "minutes_SECONDS", seconds
    )
    stamped = timed.withColumns(
        {
            "DNP_FLAG": C.did_not_play(F.col("minutes_SECONDS")),
            "GAMES_PLAYED_FLAG": C.played(F.col("minutes_SECONDS")),
            "INGESTED_AT_UTC": F.lit(ingested_at),
            "LOAD_BATCH_ID": F.lit(C.batch_id(ingested_at)),
            "ROW_KEY": C.row_key(F.col("GAME_ID"), F.col("PLAYER_ID")),
        }
    )
    return lock_schema(fill_missing(stamped))


def repeated_examples(
    frames: dict[str, tuple[DataFrame, Sequence[str]]], most: int | None = 5, day: str = "GAME_DATE", games: DataFrame | None = None
) -> DataFrame:
    """Per date, up to `most` repeated keys (None: all) with their endpoint and how often they occur.

    With `games` (date and game id, once each) only the keys of these; the few repeated keys meet them, not the rows.
    """
    kept = GAME if games is not None else [day]
    reports = [
        frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows")).where("key_rows > 1").select(
            *kept, F.lit(name).alias("endpoint"),
            F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys if k != day]).alias("key"),
            "key_rows",
        )
        for name, (frame, keys) in frames.items()
    ]
    together = reduce(DataFrame.unionByName, reports)
    if games is not None:
        together = together.join(games, GAME, "left_semi").select(day, "endpoint", "key", "key_rows")
    return together if most is None else first_examples(together, most, day)


def first_examples(repeats: DataFrame, most: int = 5, day: str = "GAME_DATE") -> DataFrame:
    """Per date, the first `most` rows of what `repeated_examples` found."""
    at = F.row_number().over(Window.partitionBy(day).orderBy("endpoint", "key"))
    return repeats.withColumn("at", at).where(F.col("at") <= most).drop("at")


def repeated_keys(frames: dict[str, tuple[DataFrame, Sequence[str]]], day: str = "GAME_DATE") -> DataFrame:
    """Per date, the number of repeated keys over all named frames."""
    reports = [
        frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(day)
        for frame, keys in frames.values()
    ]
    together = reports[0]
    for report in reports[1:]:
        together = together.unionByName(report)
    return together.groupBy(day).agg(F.count(F.lit(1)).alias("bad_rows"))
