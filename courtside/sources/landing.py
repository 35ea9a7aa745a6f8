"""Landed endpoint payloads: JSON lines, read with explicit schemas so that nothing is inferred.

One folder per endpoint. Folders may be partitioned as game_date=YYYY-MM-DD, in which case a
date filter prunes them; otherwise game_date is a field of each line. A landing that grows by the day is best partitioned: for the
dates of a run only their folders are listed and read.
"""

import dataclasses
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside import schema as S
from courtside.functions.columns import to_id
from courtside.session import subfolders

BROKEN = "broken_line"
REJECT = "reject"
DAY_FOLDER = "game_date="
DAY_TEXT = r'"game_date"\s*:\s*"(\d{4}-\d{2}-\d{2})"'
GAME_TEXT = r'"game_id"\s*:\s*"([^"]+)"'
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

#: What a rejected line is kept with.
REJECT_TYPE = S.struct_of("file string\nline string\nreason string")

_GAME_ENDPOINTS = {
    "traditional": (S.TRADITIONAL_PAYLOAD, S.TRADITIONAL_ENVELOPE),
    "advanced": (S.ADVANCED_PAYLOAD, S.ADVANCED_ENVELOPE),
    "usage": (S.USAGE_PAYLOAD, S.USAGE_ENVELOPE),
    "four_factors": (S.FOUR_FACTORS_PAYLOAD, S.FOUR_FACTORS_ENVELOPE),
    "live": (S.LIVE_PAYLOAD, "game"),
}


@dataclass(frozen=True)
class Landing:
    """Where the landed payloads lie. `days` narrows it to the folders of these dates, both ends included."""

    spark: SparkSession
    root: str
    days: tuple[date, date] | None = None

    def of_days(self, first: date, last: date) -> "Landing":
        return dataclasses.replace(self, days=(first, last))

    def used(self, endpoint: str) -> None:
        """A load says that it has staged all it takes from a game endpoint or the scoreboard. What was landed stays, here."""

    def _day_folders(self, endpoint: str) -> list[str]:
        return subfolders(self.spark, f"{self.root}/{endpoint}", DAY_FOLDER)

    def _wanted(self, folders: list[str]) -> list[str]:
        """Folders of the landing's days; lines without a date may belong to any."""
        if self.days is None:
            return folders
        first, last = map(str, self.days)
        names = [(f, f.rsplit(DAY_FOLDER, 1)[1]) for f in folders]
        return [f for f, name in names if first <= name <= last or name == NO_DAY]

    def _read(self, endpoint: str, schema: T.StructType, folders: list[str] | None = None) -> DataFrame:
        """Every line, with the text of one that could not be parsed in BROKEN."""
        schema = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
        read = self.spark.read.schema(schema).option("columnNameOfCorruptRecord", BROKEN).option("mode", "PERMISSIVE")
        base = f"{self.root}/{endpoint}"
        folders = self._day_folders(endpoint) if folders is None else folders
        wanted = self._wanted(folders)
        if len(wanted) == len(folders):
            return read.json(base)
        if not wanted:
            return read.option("basePath", base).json(folders[0]).where("false")
        return read.option("basePath", base).json(wanted)

    def scoreboard(self) -> DataFrame:
        """Every line; `broken_line` holds the text of one that could not be parsed.

        Its date is known if the folder is partitioned by date, and null otherwise.
        """
        return self._read("scoreboard", S.SCOREBOARD_PAYLOAD)

    def traditional(self) -> DataFrame:
        return self._read("traditional", S.TRADITIONAL_PAYLOAD).drop(BROKEN)

    def advanced(self) -> DataFrame:
        return self._read("advanced", S.ADVANCED_PAYLOAD).drop(BROKEN)

    def usage(self) -> DataFrame:
        return self._read("usage", S.USAGE_PAYLOAD).drop(BROKEN)

    def four_factors(self) -> DataFrame:
        return self._read("four_factors", S.FOUR_FACTORS_PAYLOAD).drop(BROKEN)

    def live(self) -> DataFrame:
        return self._read("live", S.LIVE_PAYLOAD).drop(BROKEN)

    def season_players(self) -> DataFrame:
        return season_player_ids(self._read("season_players", S.SEASON_PLAYERS).drop(BROKEN))

    def player_info(self) -> DataFrame:
        return self._read("player_info", S.PLAYER_INFO).drop(BROKEN)

    def checked(self, endpoint: str) -> DataFrame:
        """The payloads of a game endpoint with REJECT, null for a sound line, else its file, text and reason.

        A line is rejected if it is malformed or has no date, no game id or no payload. Date and game of a malformed line are taken from its text
        where they can be found, and the date from its folder if there is one.
        """
        schema, envelope = _GAME_ENDPOINTS[endpoint]
        folders = self._day_folders(endpoint)
        lines = self._read(endpoint, schema, folders)
        day, game = F.col("game_date"), F.col("game_id")
        if not folders:
            day = F.coalesce(day, _found(DAY_TEXT).try_cast("date"))
        game = F.coalesce(game, _found(GAME_TEXT))
        reason = (
            F.when(F.col(BROKEN).isNotNull(), "malformed")
            .when(day.isNull(), "no date")
            .when(game.isNull(), "no game id")
            .when(F.col(envelope).isNull(), "no payload")
        )
        return lines.select(day.alias("game_date"), game.alias("game_id"), envelope, _reject(reason, schema.names).alias(REJECT))

    def checked_scoreboard(self) -> DataFrame:
        """The scoreboard lines with BROKEN and with REJECT, set for malformed lines and those without games."""
        lines = self.scoreboard()
        day = F.col("game_date")
        if not self._day_folders("scoreboard"):
            day = F.coalesce(day, _found(DAY_TEXT).try_cast("date"))
        reason = (
            F.when(F.col(BROKEN).isNotNull(), "malformed")
            .when(day.isNull(), "no date")
            .when(F.col("scoreboard.games").isNull(), "no games")
        )
        return lines.select(day.alias("game_date"), "scoreboard", BROKEN, _reject(reason, S.SCOREBOARD_PAYLOAD.names).alias(REJECT))

    def checked_info(self) -> DataFrame:
        """The player attributes with REJECT, set for malformed lines and those without an id."""
        reason = F.when(F.col(BROKEN).isNotNull(), "malformed").when(F.col("PLAYER_ID").isNull(), "no player id")
        names = S.PLAYER_INFO.names
        return self._read("player_info", S.PLAYER_INFO).select(*names, _reject(reason, names).alias(REJECT))


def _found(pattern: str) -> Column:
    return F.nullif(F.regexp_extract(BROKEN, pattern, 1), F.lit(""))


def _reject(reason: Column, names: Sequence[str]) -> Column:
    line = F.coalesce(F.col(BROKEN), F.to_json(F.struct(*names)))
    return F.when(reason.isNotNull(), F.struct(F.col("_metadata.file_path").alias("file"), line.alias("line"), reason.alias("reason")))


def sound(rows: DataFrame) -> DataFrame:
    """The rows of lines that were not rejected."""
    return rows.where(F.col(REJECT).isNull()).drop(REJECT)


def rejected(rows: DataFrame, endpoint: str, day: str = "GAME_DATE", game: str = "GAME_ID") -> DataFrame:
    """One row per rejected line: endpoint, GAME_DATE and GAME_ID as far as known, file, line, reason."""
    known = [
        (F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(shown)
        for name, kind, shown in ((day, "date", "GAME_DATE"), (game, "string", "GAME_ID"))
    ]
    return rows.where(F.col(REJECT).isNotNull()).select(F.lit(endpoint).alias("endpoint"), *known, f"{REJECT}.*")


def for_days(payload: DataFrame, first: date, last: date, excluded: Sequence[date], undated: bool = False) -> DataFrame:
    """The payloads of a run's dates, with `undated` also those without a date."""
    day = F.col("game_date")
    kept = day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    if excluded:
        kept &= ~day.isin(*[F.lit(value).cast("date") for value in excluded])
    return payload.where(kept | day.isNull() if undated else kept)


def season_player_ids(listed: DataFrame, person: str = "PERSON_ID") -> DataFrame:
    """Distinct numeric ids of a season's player list; unparseable ones are left out."""
    return listed.select(to_id(F.col(person)).alias("PLAYER_ID")).dropna().distinct()


def player_attributes(info: DataFrame, wanted: DataFrame, player: str = "PLAYER_ID") -> DataFrame:
    """POSITION, HEIGHT and EXP of the wanted ids; one row per id even if info was landed twice.

    Of several rows, one with the fewest absent attributes is taken, then the smallest. An absent experience stays
    null and fails the null gate; it does not become text.
    """
    found = info.join(wanted.select(player).distinct(), player, "left_semi")
    values = ["POSITION", "HEIGHT", F.col("SEASON_EXP").cast("string").alias("EXP")]
    absent = sum(F.col(name).isNull().cast("int") for name in ("POSITION", "HEIGHT", "SEASON_EXP"))
    best = F.min(F.struct(absent.alias("absent"), *values)).alias("a")
    return found.groupBy(player).agg(best).select(player, "a.POSITION", "a.HEIGHT", "a.EXP")
