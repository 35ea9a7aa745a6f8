"""Nested endpoint payloads to flat rows. Purely per-document work: no shuffle here."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.functions import columns as C
from courtside.schema import FOUR_FACTORS, FOUR_FACTORS_ENVELOPE, struct_of

IDENTITY = ["GAME_DATE", "GAME_ID", "PLAYER_ID", "PLAYER_NAME", "TEAM_ID", "TEAM_TRICODE"]
SECONDARY_IDENTITY = ["PLAYER_NAME", "TEAM_TRICODE"]
STAT_KEYS = ["GAME_DATE", "GAME_ID", "PLAYER_ID", "TEAM_ID"]

# Team columns of the four-factor endpoint that are stored under a suffix.
TEAM_SUFFIX = "_TEAM"
OFFICIAL_SLOTS = 3


def _carried(payload: DataFrame) -> list[str]:
    """The mark of rejected lines, if the payloads have it. A rejected line gives one row, so that its mark is kept."""
    return ["reject"] if "reject" in payload.columns else []


def _entries(entries, first, carried: Sequence[str]):
    """The entries to explode: all of a sound line, one of a rejected one."""
    return F.when(F.col("reject").isNull(), entries).otherwise(F.array(first)) if carried else entries


def _envelope(payload: DataFrame, envelopes: Sequence[str]):
    found = [F.col(name) for name in envelopes if name in payload.columns]
    if not found:
        raise ValueError(f"none of {list(envelopes)} among {payload.columns}")
    return F.coalesce(*found)


def scoreboard_games(scoreboard: DataFrame) -> DataFrame:
    """One row per listed game; a payload without its scoreboard or games field is an error."""
    games = (
        F.when(F.col("scoreboard").isNull(), F.raise_error(F.lit("scoreboard payload has no scoreboard")))
        .when(F.col("scoreboard.games").isNull(), F.raise_error(F.lit("scoreboard payload has no games")))
        .otherwise(F.col("scoreboard.games"))
    )
    return scoreboard.select(
        F.col("game_date").alias("GAME_DATE"), F.explode(games).alias("g")
    ).select("GAME_DATE", F.col("g.gameId").cast("string").alias("GAME_ID"))


def board_lines(scoreboard: DataFrame) -> DataFrame:
    """One row per scoreboard line: its date, whether it is broken, and the ids of its games, null ones too.

    A line is broken if it could not be parsed or lacks its scoreboard or games. Nothing is dropped and nothing raised.
    """
    games = F.col("scoreboard.games")
    broken = games.isNull()
    if "broken_line" in scoreboard.columns:
        broken = broken | F.col("broken_line").isNotNull()
    return scoreboard.select(
        F.col("game_date").alias("GAME_DATE"),
        broken.alias("broken"),
        F.transform(games, lambda g: g["gameId"].cast("string")).alias("game_ids"),
        *_carried(scoreboard),
    )


def listed_games(lines: DataFrame) -> DataFrame:
    """One row per listed game of the lines that are not broken; an unidentified game has a null id."""
    return lines.where("not broken").select("GAME_DATE", F.explode("game_ids").alias("GAME_ID"))


def player_rows(payload: DataFrame, envelopes: Sequence[str]) -> DataFrame:
    """One row per player of both sides, home first; a side without players gives no rows."""
    carried = _carried(payload)
    sides = payload.select(
        F.col("game_date").alias("GAME_DATE"),
        F.col("game_id").cast("string").alias("GAME_ID"),
        _envelope(payload, envelopes).alias("e"),
        *carried,
    )
    both = F.array("e.homeTeam", "e.awayTeam")
    teams = sides.select("GAME_DATE", "GAME_ID", F.explode(_entries(both, F.col("e.homeTeam"), carried)).alias("t"), *carried)
    listed = F.col("t.players")
    players = teams.select(
        "GAME_DATE",
        "GAME_ID",
        C.to_id(F.col("t.teamId")).alias("TEAM_ID"),
        F.col("t.teamTricode").alias("teamTricode"),
        F.explode(_entries(listed, F.get(listed, F.lit(0)), carried)).alias("p"),
        *carried,
    )
    return players.select(
        "GAME_DATE",
        "GAME_ID",
        C.to_id(F.col("p.personId")).alias("PLAYER_ID"),
        C.player_name(
            F.col("p.displayName"), F.col("p.firstName"), F.col("p.familyName")
        ).alias("PLAYER_NAME"),
        "TEAM_ID",
        F.col("teamTricode").alias("TEAM_TRICODE"),
        "p.statistics.*",
        *carried,
    )


def suffixed(rows: DataFrame, suffix: str, keys: Sequence[str] = STAT_KEYS) -> DataFrame:
    """A secondary statistics table: identity columns off, every non-key column under the suffix."""
    bare = rows.drop(*SECONDARY_IDENTITY)
    return bare.withColumnsRenamed(
        {name: name + suffix for name in bare.columns if name not in keys}
    )


def as_player_team(rows: DataFrame) -> DataFrame:
    """Team columns under their role in the player row."""
    return rows.withColumnsRenamed(
        {"TEAM_ID": "PLAYER_TEAM_ID", "TEAM_TRICODE": "PLAYER_TEAM_TRICODE"}
    )


def team_factor_rows(payload: DataFrame, envelopes: Sequence[str] = (FOUR_FACTORS_ENVELOPE,)) -> DataFrame:
    """Two team rows per game with the stored names of the four-factor columns."""
    carried = _carried(payload)
    both = F.array("e.homeTeam", "e.awayTeam")
    teams = payload.select(
        F.col("game_date").alias("GAME_DATE"),
        F.col("game_id").cast("string").alias("GAME_ID"),
        _envelope(payload, envelopes).alias("e"),
        *carried,
    ).select("GAME_DATE", "GAME_ID", F.explode(_entries(both, F.col("e.homeTeam"), carried)).alias("t"), *carried)
    flat = teams.select(
        "GAME_DATE", "GAME_ID", C.to_id(F.col("t.teamId")).alias("PLAYER_TEAM_ID"), "t.statistics.*", *carried
    )
    factors = struct_of(FOUR_FACTORS).names
    return flat.drop("minutes").withColumnsRenamed(
        {name: name + TEAM_SUFFIX for name in factors if name in flat.columns}
    )


def live_game_rows(payload: DataFrame) -> DataFrame:
    """One row of game facts per live payload; absent fields become null."""
    officials = F.col("game.officials")
    slots = range(OFFICIAL_SLOTS)
    return payload.select(
        F.col("game_date").alias("GAME_DATE"),
        F.col("game_id").cast("string").alias("GAME_ID"),
        F.col("game.gameStatusText").alias("GAME_STATUS"),
        F.col("game.gameTimeUTC").alias("GAME_TIME_UTC"),
        C.to_id(F.col("game.homeTeam.teamId")).alias("HOME_TEAM_ID"),
        F.col("game.homeTeam.teamTricode").alias("HOME_TEAM_TRICODE"),
        C.to_id(F.col("game.awayTeam.teamId")).alias("AWAY_TEAM_ID"),
        F.col("game.awayTeam.teamTricode").alias("AWAY_TEAM_TRICODE"),
        F.col("game.homeTeam.score").cast("bigint").alias("HOME_TEAM_POINTS"),
        F.col("game.awayTeam.score").cast("bigint").alias("AWAY_TEAM_POINTS"),
        *[C.official(officials, i, "personId").alias(f"REFEREE_{i + 1}_ID") for i in slots],
        *[C.official(officials, i, "name").alias(f"REFEREE_{i + 1}_NAME") for i in slots],
        *_carried(payload),
    )
