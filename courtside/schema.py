"""Column lists and Spark schemas of the landed payloads and the stored tables."""

from pyspark.sql import types as T

# Column names, their order and their types.
# An endpoint's statistics are listed once; the stored name is the listed name plus the endpoint's suffix.
IDENTITY = """
PLAYER_ID bigint
PLAYER_NAME string
PLAYER_TEAM_ID bigint
PLAYER_TEAM_TRICODE string
HOME_FLAG boolean
GAME_ID string
ROW_KEY string
GAME_DATE date
"""

GAME_CONTEXT = """
HOME_TEAM_ID bigint
HOME_TEAM_TRICODE string
HOME_TEAM_POINTS bigint
AWAY_TEAM_ID bigint
AWAY_TEAM_TRICODE string
AWAY_TEAM_POINTS bigint
POINT_MARGIN bigint
GAME_TOTAL_POINTS bigint
HOME_TEAM_WIN_FLAG boolean
PLAYER_TEAM_WIN_FLAG boolean
GAME_STATUS string
GAME_TIME_UTC string
ARENA_NAME string
ARENA_CITY string
ARENA_STATE string
"""

PLAYER_CONTEXT = """
POSITION string
HEIGHT string
EXP string
minutes string
minutes_SECONDS bigint
DNP_FLAG boolean
GAMES_PLAYED_FLAG boolean
"""

TRADITIONAL = """
fieldGoalsMade bigint
fieldGoalsAttempted bigint
fieldGoalsPercentage double
threePointersMade bigint
threePointersAttempted bigint
threePointersPercentage double
freeThrowsMade bigint
freeThrowsAttempted bigint
freeThrowsPercentage double
reboundsOffensive bigint
reboundsDefensive bigint
reboundsTotal bigint
assists bigint
steals bigint
blocks bigint
turnovers bigint
foulsPersonal bigint
points bigint
plusMinusPoints double
"""

ADVANCED = """
estimatedOffensiveRating double
offensiveRating double
estimatedDefensiveRating double
defensiveRating double
estimatedNetRating double
netRating double
assistPercentage double
assistToTurnover double
assistRatio double
offensiveReboundPercentage double
defensiveReboundPercentage double
reboundPercentage double
turnoverRatio double
effectiveFieldGoalPercentage double
trueShootingPercentage double
usagePercentage double
estimatedUsagePercentage double
estimatedPace double
pace double
pacePer40 double
possessions double
PIE double
"""

USAGE = """
usagePercentage double
percentageFieldGoalsMade double
percentageFieldGoalsAttempted double
percentageThreePointersMade double
percentageThreePointersAttempted double
percentageFreeThrowsMade double
percentageFreeThrowsAttempted double
percentageReboundsOffensive double
percentageReboundsDefensive double
percentageReboundsTotal double
percentageAssists double
percentageTurnovers double
percentageSteals double
percentageBlocks double
percentageBlocksAllowed double
percentagePersonalFouls double
percentagePersonalFoulsDrawn double
percentagePoints double
"""

FOUR_FACTORS = """
effectiveFieldGoalPercentage double
freeThrowAttemptRate double
teamTurnoverPercentage double
offensiveReboundPercentage double
oppEffectiveFieldGoalPercentage double
oppFreeThrowAttemptRate double
oppTeamTurnoverPercentage double
oppOffensiveReboundPercentage double
"""

OFFICIALS = """
REFEREE_1_ID bigint
REFEREE_2_ID bigint
REFEREE_3_ID bigint
REFEREE_1_NAME string
REFEREE_2_NAME string
REFEREE_3_NAME string
"""

LINEAGE = """
INGESTED_AT_UTC timestamp
LOAD_BATCH_ID string
"""

PLAYER_DIMENSION_COLUMNS = """
PLAYER_ID bigint
POSITION string
HEIGHT string
EXP string
LAST_UPDATED_UTC timestamp
"""

ARENA_DIMENSION_COLUMNS = """
TEAM_ID bigint
TEAM_TRICODE string
ARENA_NAME string
ARENA_CITY string
ARENA_STATE string
LAST_UPDATED_UTC timestamp
"""
# End of fixed values.

_TYPES = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "int": T.IntegerType(),
}


def struct_of(text: str, suffix: str = "") -> T.StructType:
    """A struct from lines of `name type`."""
    pairs = (line.split() for line in text.strip().splitlines())
    return T.StructType([T.StructField(name + suffix, _TYPES[kind]) for name, kind in pairs])


PLAYER_GAME = T.StructType(
    struct_of(IDENTITY).fields
    + struct_of(GAME_CONTEXT).fields
    + struct_of(PLAYER_CONTEXT).fields
    + struct_of(TRADITIONAL).fields
    + struct_of(ADVANCED, "_ADV").fields
    + struct_of(USAGE, "_USAGE").fields
    + struct_of(FOUR_FACTORS, "_TEAM").fields
    + struct_of(OFFICIALS).fields
    + struct_of(LINEAGE).fields
)

PLAYER_DIMENSION = struct_of(PLAYER_DIMENSION_COLUMNS)
ARENA_DIMENSION = struct_of(ARENA_DIMENSION_COLUMNS)

LEDGER = struct_of("""
GAME_DATE date
STATUS string
ROWS bigint
LOAD_BATCH_ID string
BATCH_NO int
""")

GAME_STATE = struct_of("""
whole_game boolean
GAME_ID string
PLAYER_TEAM_ID bigint
total_rows bigint
players bigint
row_keys bigint
teams bigint
GAME_DATE date
""")

REJECTS = struct_of("""
endpoint string
GAME_DATE date
GAME_ID string
file string
line string
reason string
LOAD_BATCH_ID string
""")

# ---- landed payloads -------------------------------------------------------
# Every landed row carries its date and game; ids stay text so that bad ones reach the coercion step.

_LANDED_KEYS = struct_of("""
game_date date
game_id string
""").fields

# The envelope key of each box-score endpoint.
TRADITIONAL_ENVELOPE = "boxScoreTraditional"
ADVANCED_ENVELOPE = "boxScoreAdvanced"
USAGE_ENVELOPE = "boxScoreUsage"
FOUR_FACTORS_ENVELOPE = "boxScoreFourFactors"


def _player_struct(statistics: T.StructType) -> T.StructType:
    names = struct_of("personId string\ndisplayName string\nfirstName string\nfamilyName string")
    return names.add("statistics", statistics)


def box_score_schema(envelope: str, statistics: T.StructType) -> T.StructType:
    team = struct_of("teamId string\nteamTricode string").add(
        "players", T.ArrayType(_player_struct(statistics))
    )
    sides = T.StructType().add("homeTeam", team).add("awayTeam", team)
    return T.StructType(list(_LANDED_KEYS)).add(envelope, sides)


_MINUTES = struct_of("minutes string").fields

TRADITIONAL_PAYLOAD = box_score_schema(
    TRADITIONAL_ENVELOPE, T.StructType(_MINUTES + struct_of(TRADITIONAL).fields)
)
ADVANCED_PAYLOAD = box_score_schema(
    ADVANCED_ENVELOPE, T.StructType(_MINUTES + struct_of(ADVANCED).fields)
)
USAGE_PAYLOAD = box_score_schema(USAGE_ENVELOPE, T.StructType(_MINUTES + struct_of(USAGE).fields))

_FACTOR_TEAM = struct_of("teamId string").add(
    "statistics", T.StructType(_MINUTES + struct_of(FOUR_FACTORS).fields)
)
FOUR_FACTORS_PAYLOAD = T.StructType(list(_LANDED_KEYS)).add(
    FOUR_FACTORS_ENVELOPE,
    T.StructType().add("homeTeam", _FACTOR_TEAM).add("awayTeam", _FACTOR_TEAM),
)

_LIVE_TEAM = struct_of("teamId bigint\nteamTricode string\nscore bigint")
LIVE_PAYLOAD = T.StructType(list(_LANDED_KEYS)).add(
    "game",
    T.StructType()
    .add("homeTeam", _LIVE_TEAM)
    .add("awayTeam", _LIVE_TEAM)
    .add("gameStatusText", T.StringType())
    .add("gameTimeUTC", T.StringType())
    .add("officials", T.ArrayType(struct_of("personId bigint\nname string"))),
)

SCOREBOARD_PAYLOAD = T.StructType([_LANDED_KEYS[0]]).add(
    "scoreboard", T.StructType().add("games", T.ArrayType(struct_of("gameId string")))
)

SEASON_PLAYERS = struct_of("PERSON_ID string")
PLAYER_INFO = struct_of("PLAYER_ID bigint\nPOSITION string\nHEIGHT string\nSEASON_EXP string")
