"""Landed payloads derived from the given tables: one game per order, two players a side and more in some.

The same formulas serve Spark (to write the JSON) and the SQL that the loaded rows must agree with.
A document has at most MOST_PLAYERS players, so no order can make a large one.
"""

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from courtside import schema as S
from courtside.operators import payloads
from courtside.plans.day_load import LoadResult, load_days
from courtside.plans.dimensions import build_player_dimension
from courtside.session import discard, exists, scratch_folder, shuffles_dropped
from courtside.sources.landing import Landing
from courtside.sources.store import Store
from courtside.workload.registry import dealt, table

INGESTED = datetime(2026, 3, 14, 5, 20, 56, tzinfo=timezone.utc)
FIRST_DAY, LAST_DAY = "01/01/1990", "12/31/2010"

HOME_TEAM = "(1610612737 + o_custkey % 30)"
AWAY_TEAM = "(1610612737 + (o_custkey + 1 + o_orderkey % 29) % 30)"

# A game has four players and, in some, substitutes: odd slots play at home, so that sides have two to seven players.
MOST_PLAYERS = 14
PLAYERS = """(4 + case o_orderkey % 64 when 0 then 2 when 1 then 4 when 2 then 5 when 3 then 6 when 4 then 7
    when 5 then 10 else 0 end)"""
#: Substitutes come from so many rosters, apart from the customers' players.
ROSTERS, FIRST_SUBSTITUTE = 50, 1000000000


def at_home(slot: str) -> str:
    return f"({slot} <= 2 or ({slot} > 4 and {slot} % 2 = 1))"


# Months in which one kind of order breaks a gate on its date.
SHORT_OFFICIALS = "(month(o_orderdate) = 2 and o_orderstatus = 'P')"
UNPLAYED_GAME = "(month(o_orderdate) = 5 and o_orderpriority = '3-MEDIUM')"
REPEATED_PLAYER = "(month(o_orderdate) = 8 and o_orderpriority = '5-LOW')"
NEGATIVE_MINUTES = "(month(o_orderdate) = 11 and o_orderpriority = '1-URGENT')"
BROKEN_BOARD = "(month(o_orderdate) = 3 and year(o_orderdate) = 1998 and o_orderpriority = '4-NOT SPECIFIED')"
UNIDENTIFIED_GAME = "(month(o_orderdate) = 4 and year(o_orderdate) = 1995 and o_orderpriority = '2-HIGH')"


def whole(slot: str, i: int) -> str:
    return f"((o_orderkey + {slot} * 7 + {i}) % 30)"


def share(slot: str, i: int, spread: int) -> str:
    return f"(((o_orderkey * {spread} + {slot} * 5 + {i}) % 1000) / 1000.0)"


def player_id(slot: str) -> str:
    return f"(case when {slot} > 4 then {FIRST_SUBSTITUTE} + o_custkey % {ROSTERS} * 32 + {slot} else o_custkey * 4 + {slot} end)"


def minutes(slot: str) -> str:
    return f"""case when {NEGATIVE_MINUTES} and {slot} = 1 then '-1:30'
      when {slot} = 4 and o_orderstatus = 'F' then null
      else concat((o_orderkey + {slot}) % 48, ':', (o_orderkey * {slot}) % 60) end"""


def statistics(endpoint: str, slot: str) -> dict[str, str]:
    """SQL per statistic of an endpoint."""
    if endpoint == "traditional":
        fields = S.struct_of(S.TRADITIONAL).fields
        return {
            f.name: whole(slot, i) if f.dataType.simpleString() == "bigint" else share(slot, i, 3)
            for i, f in enumerate(fields)
        }
    text, spread = {
        "advanced": (S.ADVANCED, 7), "usage": (S.USAGE, 11), "four_factors": (S.FOUR_FACTORS, 13)
    }[endpoint]
    return {name: share(slot, i, spread) for i, name in enumerate(S.struct_of(text).names)}


def _struct(parts: dict[str, str]) -> str:
    return "struct(" + ", ".join(f"{sql} as `{name}`" for name, sql in parts.items()) + ")"


def _typed(endpoint: str, slot: str, text: str) -> dict[str, str]:
    kinds = {f.name: f.dataType.simpleString() for f in S.struct_of(text).fields}
    # Spark takes 1000.0 for a decimal; divided as doubles the shares are the same, as both ways give the double next to the quotient.
    return {n: f"cast({sql.replace('/ 1000.0', '/ 1000.0D')} as {kinds[n]})" for n, sql in statistics(endpoint, slot).items()}


def _player(endpoint: str, slot: str, text: str) -> str:
    pid = player_id(slot)
    stats = _typed(endpoint, slot, text)
    stats["minutes"] = minutes(slot) if endpoint == "traditional" else "'12:00'"
    return _struct(
        {
            "personId": f"cast({pid} as string)",
            "displayName": f"if({slot} = 2, '', concat('Player ', {pid}))",
            "firstName": "'First'",
            "familyName": f"concat('Family', {pid})",
            "statistics": _struct(stats),
        }
    )


def _box(endpoint: str, envelope: str, text: str, repeats: bool = False) -> str:
    def side(team: str, suffix: str, slots: tuple[str, ...]) -> str:
        players = "array(" + ", ".join(_player(endpoint, s, text) for s in slots) + ")"
        first = 5 if "1" in slots else 6
        substitutes = f"transform(sequence({first}, {PLAYERS}, 2), s -> {_player(endpoint, 's', text)})"
        players = f"if({PLAYERS} < {first}, {players}, concat({players}, {substitutes}))"
        if repeats and "1" in slots:
            repeated = f"array({_player(endpoint, '1', text)})"
            players = f"if({REPEATED_PLAYER}, concat({players}, {repeated}), {players})"
        return _struct(
            {
                "teamId": f"concat({team}, '{suffix}')",
                "teamTricode": f"concat('T', {team} - 1610612736)",
                "players": players,
            }
        )

    sides = {"homeTeam": side(HOME_TEAM, "", ("1", "2")), "awayTeam": side(AWAY_TEAM, ".0", ("3", "4"))}
    return f"{_struct(sides)} as {envelope}"


def _factors() -> str:
    def side(team: str, slot: str) -> str:
        stats = _typed("four_factors", slot, S.FOUR_FACTORS) | {"minutes": "'240:00'"}
        return _struct({"teamId": f"cast({team} as string)", "statistics": _struct(stats)})

    sides = {"homeTeam": side(HOME_TEAM, "1"), "awayTeam": side(AWAY_TEAM, "2")}
    return f"{_struct(sides)} as {S.FOUR_FACTORS_ENVELOPE}"


def official_id(position: int) -> str:
    return f"(1000 + (o_orderkey + {position}) % 50)"


HOME_SCORE = "(o_custkey % 90 + o_orderkey % 60)"
AWAY_SCORE = "(o_orderkey % 149)"


def _live() -> str:
    def side(team: str, score: str) -> str:
        return _struct({"teamId": team, "teamTricode": f"concat('T', {team} - 1610612736)", "score": score})

    officials = ", ".join(
        _struct({"personId": official_id(i), "name": f"concat('Official ', {official_id(i)})"}) for i in (1, 2, 3)
    )
    game = {
        "homeTeam": side(HOME_TEAM, HOME_SCORE),
        "awayTeam": side(AWAY_TEAM, AWAY_SCORE),
        "gameStatusText": "o_orderpriority",
        "gameTimeUTC": "concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T00:00:00Z')",
        "officials": f"slice(array({officials}), 1, if({SHORT_OFFICIALS}, 2, 3))",
    }
    return f"{_struct(game)} as game"


def payloads_of(
    spark: SparkSession, sf_dir: str, repeats: bool = True, by_date: bool = False, names: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Every endpoint's payloads as frames, or those of the named ones.

    `repeats` puts some players twice into an advanced box, and every endpoint holds some games twice that are on no
    scoreboard. With `by_date` dates are dealt to tasks and lie together there: it is the orders that move, before a payload is made of them.
    Otherwise they are dealt out evenly if they lie in few files.
    """
    orders = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderdate as date) as game_date", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"
    )
    orders = orders if by_date else dealt(orders)
    own = "struct(lpad(cast(o_orderkey as string), 10, '0') as gameId)"
    listed = f"""struct(case when {BROKEN_BOARD} then null
        when {UNIDENTIFIED_GAME} then array({own}, struct(cast(null as string) as gameId))
        when {UNPLAYED_GAME} then array({own}, struct(concat('9', o_orderkey) as gameId))
        else array({own}) end as games) as scoreboard"""
    copies = "if(o_orderkey % 50 = 0, array(0, 1, 2), array(0))" if repeats else "array(0)"
    games = orders.withColumn("copy", F.expr(f"explode({copies})"))
    game_id = "if(copy = 0, lpad(cast(o_orderkey as string), 10, '0'), concat('8', o_orderkey)) as game_id"
    dealt_orders, dealt_games = (_by_date(orders), _by_date(games)) if by_date else (orders, games)

    def game(payload: str) -> DataFrame:
        return dealt_games.selectExpr("game_date", game_id, payload)

    people = table(spark, sf_dir, "customer").select(
        F.expr("explode(array(1, 2, 3, 4))").alias("slot"), "c_custkey", "c_mktsegment", "c_nationkey"
    )
    # Those of the rosters that the orders name, which are no more than there are rosters.
    rosters = orders.selectExpr(f"o_custkey % {ROSTERS} as roster").distinct()
    substitutes = rosters.withColumn("slot", F.expr(f"explode(sequence(5, {MOST_PLAYERS}))")).selectExpr(
        f"{FIRST_SUBSTITUTE} + roster * 32 + slot as PLAYER_ID", "'Substitute' as POSITION",
        "concat('6-', slot) as HEIGHT", "cast(slot as string) as SEASON_EXP",
    )
    made = {
        "scoreboard": lambda: dealt_orders.selectExpr("game_date", listed),
        "traditional": lambda: game(_box("traditional", S.TRADITIONAL_ENVELOPE, S.TRADITIONAL)),
        "advanced": lambda: game(_box("advanced", S.ADVANCED_ENVELOPE, S.ADVANCED, repeats)),
        "usage": lambda: game(_box("usage", S.USAGE_ENVELOPE, S.USAGE)),
        "four_factors": lambda: game(_factors()),
        "live": lambda: game(_live()),
        "season_players": lambda: people.where("slot < 4").selectExpr("cast(c_custkey * 4 + slot as string) as PERSON_ID"),
        "player_info": lambda: people.selectExpr(
            "c_custkey * 4 + slot as PLAYER_ID", "c_mktsegment as POSITION",
            "concat('6-', c_nationkey) as HEIGHT", "cast(c_nationkey + slot as string) as SEASON_EXP",
        ).unionByName(substitutes),
    }
    return {name: made[name]() for name in names or made}


#: Endpoints that land by date; the others are about players.
DATED = ("scoreboard", "traditional", "advanced", "usage", "four_factors", "live")
UNDATED = ("season_players", "player_info")
# Compressed files are read whole by a task, so they are kept small.
LINES_PER_FILE = 100_000

_landings: dict[tuple[str, str], tuple[Landing, set[str]]] = {}
_flat: dict[tuple[str, str], list[DataFrame]] = {}
_loads: dict[tuple[str, str], tuple[Store, LoadResult]] = {}


def landing_of(spark: SparkSession, sf_dir: str, *endpoints: str) -> Landing:
    """The payloads written as compressed JSON lines in folders by date, once per session and folder of tables.

    Those of the named endpoints, by default of all.
    """
    key = (spark.conf.get("spark.app.id"), sf_dir)
    landing, there = _landings.setdefault(key, (Landing(spark, scratch_folder(spark, "landing")), set()))
    for name in (*DATED, *UNDATED):
        if name not in there and (not endpoints or name in endpoints):
            _land_by_date(spark, sf_dir, name, landing.root)
            there.add(name)
    return landing


def _landed_writer(payload: DataFrame) -> DataFrameWriter:
    """Fast compression: the landed text is read once or a few times."""
    return payload.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")


def _land_by_date(spark: SparkSession, sf_dir: str, name: str, root: str) -> None:
    writer = _landed_writer(payloads_of(spark, sf_dir, by_date=True, names=[name])[name])
    with shuffles_dropped(spark):
        (writer.partitionBy("game_date") if name in DATED else writer).json(f"{root}/{name}")


def _land(spark: SparkSession, sf_dir: str, name: str, root: str) -> None:
    """Lines of all dates in the same files, each with its date: for a reader of all dates, folders by date would be thousands of small files."""
    writer = _landed_writer(payloads_of(spark, sf_dir, names=[name])[name]).option("maxRecordsPerFile", LINES_PER_FILE)
    with shuffles_dropped(spark):
        writer.json(f"{root}/{name}")


@dataclass(frozen=True)
class LandingAtNeed(Landing):
    """Payloads that land when a load first reads their endpoint and go when it has used them, so that one game endpoint lies there at a time."""

    sf_dir: str = ""

    def _day_folders(self, endpoint: str) -> list[str]:
        if not exists(self.spark, f"{self.root}/{endpoint}"):
            _land(self.spark, self.sf_dir, endpoint, self.root)
        return super()._day_folders(endpoint)

    def used(self, endpoint: str) -> None:
        discard(self.spark, f"{self.root}/{endpoint}")


def _by_date(orders: DataFrame) -> DataFrame:
    """Dates are dealt to tasks, so that a date is one file unless it is large."""
    dealt = orders.repartition(orders.sparkSession.sparkContext.defaultParallelism, "game_date")
    return dealt.sortWithinPartitions("game_date")


def flat_endpoints(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Flat rows of the five game endpoints, staged as parquet once per session and folder of tables.

    Staged as a load stages them, so that key checks and joins read columns and parse nothing again.
    The payloads are those without repeated players, which the 1:1 joins would refuse.
    """
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _flat:
        nested = payloads_of(spark, sf_dir, repeats=False)
        rows = {
            "traditional": payloads.player_rows(nested["traditional"], [S.TRADITIONAL_ENVELOPE]),
            "advanced": payloads.player_rows(nested["advanced"], [S.ADVANCED_ENVELOPE]),
            "usage": payloads.player_rows(nested["usage"], [S.USAGE_ENVELOPE]),
            "four_factors": payloads.team_factor_rows(nested["four_factors"]),
            "live": payloads.live_game_rows(nested["live"]),
        }
        root = scratch_folder(spark, "endpoints")
        staged = []
        for name, df in rows.items():
            df.write.option("compression", "zstd").parquet(f"{root}/{name}")
            staged.append(spark.read.schema(df.schema).parquet(f"{root}/{name}"))
        _flat[key] = staged
    return _flat[key]


def loaded_store(spark: SparkSession, sf_dir: str) -> tuple[Store, LoadResult]:
    """A store with all landed dates loaded, once per session and folder of tables."""
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _loads:
        _loads[key] = load_all(spark, sf_dir)
    return _loads[key]


def load_all(spark: SparkSession, sf_dir: str) -> tuple[Store, LoadResult]:
    """A load of all dates, from the session's landing if all payloads are there, else from one that lands endpoint by endpoint."""
    shared, there = _landings.get((spark.conf.get("spark.app.id"), sf_dir), (None, set()))
    whole = there.issuperset((*DATED, *UNDATED))
    landing = shared if whole else LandingAtNeed(spark, scratch_folder(spark, "landing"), sf_dir=sf_dir)
    store = new_store(spark)
    build_player_dimension(store, landing.season_players(), landing.player_info(), INGESTED)
    result = load_days(landing, store, FIRST_DAY, LAST_DAY, INGESTED, max_days=None)
    if not whole:
        discard(spark, landing.root)
    return store, result


def new_store(spark: SparkSession) -> Store:
    """A store whose log is a table of the session's catalog, under a name of its own."""
    return Store(spark, scratch_folder(spark, "store"), f"player_game_log_{uuid.uuid4().hex}")


# ---- the same rows in SQL ---------------------------------------------------

DAY_SQL = "cast(o_orderdate as date)"
SLOTS_SQL = f"unnest(generate_series(1, {MOST_PLAYERS})) as slots(slot)"
BAD_SQL = (
    f"{SHORT_OFFICIALS} or {UNPLAYED_GAME} or {REPEATED_PLAYER} or {NEGATIVE_MINUTES} or {BROKEN_BOARD} or {UNIDENTIFIED_GAME}"
)


def _by_slot(home: str, away: str) -> str:
    return f"case when {at_home('slot')} then {home} else {away} end"


def _points(slots: list[int]) -> str:
    """Points of the slots that play, in SQL."""
    return "(" + " + ".join(f"case when {s} <= {PLAYERS} then {whole(str(s), 17)} else 0 end" for s in slots) + ")"


def columns_sql() -> dict[str, str]:
    """SQL per stored column, over orders, slot, customer and arenas."""
    extra = range(5, MOST_PLAYERS + 1)
    home_points = _points([1, 2, *extra[::2]])
    away_points = _points([3, 4, *extra[1::2]])
    won = f"({home_points} > {away_points})"
    margin = f"({HOME_SCORE} - {AWAY_SCORE})"
    text = f"coalesce({minutes('slot')}, '0:00')"
    parts = f"split_part({text}, ':', {{}})"
    seconds = f"(cast({parts.format(1)} as bigint) * 60 + cast({parts.format(2)} as bigint))"
    pid = player_id("slot")
    sql = {
        "PLAYER_ID": pid,
        "PLAYER_NAME": f"case when slot = 2 then concat('First Family', {pid}) else concat('Player ', {pid}) end",
        "PLAYER_TEAM_ID": _by_slot(HOME_TEAM, AWAY_TEAM),
        "PLAYER_TEAM_TRICODE": f"concat('T', {_by_slot(HOME_TEAM, AWAY_TEAM)} - 1610612736)",
        "HOME_FLAG": at_home("slot"),
        "GAME_ID": "lpad(cast(o_orderkey as varchar), 10, '0')",
        "ROW_KEY": f"concat(lpad(cast(o_orderkey as varchar), 10, '0'), '_', {pid})",
        "GAME_DATE": f"cast({DAY_SQL} as varchar)",
        "HOME_TEAM_ID": HOME_TEAM,
        "HOME_TEAM_TRICODE": f"concat('T', {HOME_TEAM} - 1610612736)",
        "HOME_TEAM_POINTS": HOME_SCORE,
        "AWAY_TEAM_ID": AWAY_TEAM,
        "AWAY_TEAM_TRICODE": f"concat('T', {AWAY_TEAM} - 1610612736)",
        "AWAY_TEAM_POINTS": AWAY_SCORE,
        "POINT_MARGIN": _by_slot(margin, f"-{margin}"),
        "GAME_TOTAL_POINTS": f"{HOME_SCORE} + {AWAY_SCORE}",
        "HOME_TEAM_WIN_FLAG": won,
        "PLAYER_TEAM_WIN_FLAG": f"{at_home('slot')} = {won}",
        "GAME_STATUS": "o_orderpriority",
        "GAME_TIME_UTC": "concat(strftime(o_orderdate, '%Y-%m-%d'), 'T00:00:00Z')",
        "ARENA_NAME": "arena_name",
        "ARENA_CITY": "arena_city",
        "ARENA_STATE": "arena_state",
        "POSITION": "case when slot > 4 then 'Substitute' else c_mktsegment end",
        "HEIGHT": "case when slot > 4 then concat('6-', slot) else concat('6-', c_nationkey) end",
        "EXP": "cast(case when slot > 4 then slot else c_nationkey + slot end as varchar)",
        "minutes": text,
        "minutes_SECONDS": seconds,
        "DNP_FLAG": f"{seconds} = 0",
        "GAMES_PLAYED_FLAG": f"{seconds} > 0",
    }
    sql |= statistics("traditional", "slot")
    sql |= {f"{n}_ADV": s for n, s in statistics("advanced", "slot").items()}
    sql |= {f"{n}_USAGE": s for n, s in statistics("usage", "slot").items()}
    side = f"(case when {at_home('slot')} then 1 else 2 end)"
    sql |= {f"{n}_TEAM": s for n, s in statistics("four_factors", side).items()}
    sql |= {f"REFEREE_{i}_ID": official_id(i) for i in (1, 2, 3)}
    sql |= {f"REFEREE_{i}_NAME": f"concat('Official ', {official_id(i)})" for i in (1, 2, 3)}
    return sql | {
        "INGESTED_AT_UTC": "'2026-03-14 05:20:56'",
        "LOAD_BATCH_ID": "'20260314052056'",
    }


def rows_sql(names: list[str] | None = None, where: str = "true") -> str:
    """The stored rows of all dates that pass, from the tables alone."""
    from courtside.workload.matching import arenas_sql

    sql = columns_sql()
    kinds = {"bigint": "bigint", "double": "double", "string": "varchar", "boolean": "boolean"}
    shown = []
    for name in names or S.PLAYER_GAME.names:
        kind = kinds.get(S.PLAYER_GAME[name].dataType.simpleString(), "varchar")
        shown.append(f"cast({sql[name]} as {kind}) as {name.lower()}")
    return f"""select {", ".join(shown)}
from orders cross join {SLOTS_SQL}
left join customer on o_custkey = c_custkey
left join {arenas_sql()} on team_id = {HOME_TEAM}
where slot <= {PLAYERS} and {where} and {DAY_SQL} not in (select {DAY_SQL} from orders where {BAD_SQL})"""
