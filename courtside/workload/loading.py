"""Writes, dimension builds, and everything that starts from landed payloads."""

from datetime import date

from pyspark.sql import functions as F

from courtside import schema as S
from courtside.operators import audits, gates, payloads
from courtside.plans import assemble as A
from courtside.plans import monitoring
from courtside.plans.dimensions import build_arena_dimension, build_player_dimension
from courtside.session import scratch_folder
from courtside.sources import store as stores
from courtside.sources.export_csv import read_export, write_export
from courtside.sources.store import Store
from courtside.workload.landed import (
    AWAY_TEAM,
    BAD_SQL,
    BROKEN_BOARD,
    HOME_TEAM,
    INGESTED,
    DAY_SQL,
    NEGATIVE_MINUTES,
    PLAYERS,
    REPEATED_PLAYER,
    SHORT_OFFICIALS,
    SLOTS_SQL,
    UNIDENTIFIED_GAME,
    UNPLAYED_GAME,
    at_home,
    columns_sql,
    flat_endpoints,
    landing_of,
    loaded_store,
    load_all,
    minutes,
    player_id,
    rows_sql,
)
from courtside.workload.matching import arenas_sql
from courtside.workload.registry import plain, query, table


def _daily_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderdate as date) as GAME_DATE", "o_orderkey", "o_custkey", "o_orderstatus"
    )


def _counts(rows):
    return rows.groupBy("GAME_DATE").agg(F.count(F.lit(1)).alias("rows"))


def _laid_out(rows):
    return stores.spread_days(rows, _counts(rows), key="o_orderkey", order=("o_custkey",))


def _replaced(spark, sf_dir):
    """All dates written, then the dates of 1996 replaced by their open orders."""
    rows = _daily_orders(spark, sf_dir)
    path = scratch_folder(spark, "orders-by-date")
    stores.replace_days(_laid_out(rows), path)
    again = rows.where("year(GAME_DATE) = 1996 and o_orderstatus = 'O'")
    stores.replace_days(_laid_out(again), path)
    return spark.read.schema(rows.schema).parquet(path)


#: Orders that are still there after the replacement; a date without an open order is not replaced.
KEPT_ORDER_SQL = f"""(year(o_orderdate) <> 1996 or o_orderstatus = 'O'
    or {DAY_SQL} not in (select {DAY_SQL} from orders where o_orderstatus = 'O'))"""


@query(f"""
select cast({DAY_SQL} as varchar) as game_date, o_orderkey, o_custkey, o_orderstatus from orders where {KEPT_ORDER_SQL}
""")
def partition_replace(spark, sf_dir):
    return plain(_replaced(spark, sf_dir))


@query(f"""
select cast({DAY_SQL} as varchar) as game_date, count(*) as expected_rows,
       count(*) filter (where {KEPT_ORDER_SQL}) as stored_rows,
       count(*) = count(*) filter (where {KEPT_ORDER_SQL}) as pass
from orders group by {DAY_SQL}
""")
def post_load_check(spark, sf_dir):
    """Row counts per date after the replacement; the replaced dates hold fewer than the source."""
    return plain(gates.row_count_check(_counts(_daily_orders(spark, sf_dir)), _replaced(spark, sf_dir)))


SUPPLIERS = S.struct_of("""
s_suppkey bigint
s_name string
s_nationkey int
""")


@query("select s_suppkey, s_name, s_nationkey from supplier")
def dimension_append(spark, sf_dir):
    """A created table filled in two overlapping appends, each adding only what is absent."""
    suppliers = table(spark, sf_dir, "supplier").select(*SUPPLIERS.names)
    path = scratch_folder(spark, "suppliers")
    spark.createDataFrame([], SUPPLIERS).write.parquet(path)
    stores.append_missing(suppliers.where("s_nationkey < 15"), path, SUPPLIERS, "s_suppkey")
    stores.append_missing(suppliers, path, SUPPLIERS, "s_suppkey")
    return spark.read.schema(SUPPLIERS).parquet(path)


@query("select s_suppkey, s_name, s_nationkey from supplier where s_nationkey >= 5")
def dimension_replace(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(*SUPPLIERS.names)
    path = scratch_folder(spark, "suppliers")
    stores.replace_all(suppliers, path)
    stores.replace_all(suppliers.where("s_nationkey >= 5"), path)
    return spark.read.schema(SUPPLIERS).parquet(path)


@query(f"""
select o_orderkey, cast(team_id as bigint) as home_team_id, tricode as team_tricode, arena_name, arena_city, arena_state
from orders join {arenas_sql()} on team_id = 1610612737 + o_custkey % 30
""")
def arena_dimension(spark, sf_dir):
    """The stored arena dimension, built twice, joined to each order's home team."""
    store = Store(spark, scratch_folder(spark, "store"))
    store.arenas(INGESTED)
    build_arena_dimension(store, INGESTED)
    arenas = store.arenas(INGESTED).withColumnRenamed("TEAM_ID", "HOME_TEAM_ID")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "1610612737 + o_custkey % 30 as HOME_TEAM_ID")
    return plain(orders.join(arenas, "HOME_TEAM_ID"))


@query("""
select c_custkey * 4 + slot as player_id, c_mktsegment as position, concat('6-', c_nationkey) as height,
       cast(c_nationkey + slot as varchar) as exp
from customer cross join (values (1), (2), (3)) as slots(slot)
""")
def player_dimension_build(spark, sf_dir):
    landing = landing_of(spark, sf_dir, "season_players", "player_info")
    store = Store(spark, scratch_folder(spark, "store"))
    build_player_dimension(store, landing.season_players(), landing.player_info(), INGESTED)
    build_player_dimension(store, landing.season_players(), landing.player_info(), INGESTED)
    return plain(store.players())


@query(f"""
select cast({DAY_SQL} as varchar) as game_date, lpad(cast(o_orderkey as varchar), 10, '0') as game_id from orders
where not {BROKEN_BOARD}
union all
select cast({DAY_SQL} as varchar), concat('9', o_orderkey) from orders where {UNPLAYED_GAME}
union all
select cast({DAY_SQL} as varchar), null from orders where {UNIDENTIFIED_GAME}
""")
def scoreboard_games(spark, sf_dir):
    """Listed games of the boards that are not broken, unidentified ones too."""
    return plain(payloads.listed_games(payloads.board_lines(landing_of(spark, sf_dir, "scoreboard").scoreboard())))


KINDS = {"bigint": "bigint", "double": "double", "boolean": "boolean"}
BEFORE_FINISH = {"minutes": minutes("slot"), "minutes_ADV": "'12:00'", "minutes_USAGE": "'12:00'"}
THIRD = {name: f"case when not {SHORT_OFFICIALS} then {columns_sql()[name]} end" for name in ("REFEREE_3_ID", "REFEREE_3_NAME")}


def _stage_sql(*groups: list[str]) -> str:
    """All columns that a stage has, in SQL over orders and slots."""
    sql, shown = columns_sql() | BEFORE_FINISH | THIRD, []
    for name in dict.fromkeys(name for group in groups for name in group):
        kind = S.PLAYER_GAME[name].dataType.simpleString() if name in S.PLAYER_GAME.names else "string"
        shown.append(f"cast({sql[name]} as {KINDS.get(kind, 'varchar')}) as {name.lower()}")
    return f"""select {", ".join(shown)} from orders cross join {SLOTS_SQL} where slot <= {PLAYERS}"""


def _named(text: str, suffix: str = "") -> list[str]:
    return [f"{name}{suffix}" for name in S.struct_of(text).names]


STAT_COLUMNS = [
    "GAME_DATE", "GAME_ID", "PLAYER_ID", "PLAYER_NAME", "PLAYER_TEAM_ID", "PLAYER_TEAM_TRICODE", "minutes", *_named(S.TRADITIONAL),
]
BOXES = [*STAT_COLUMNS, "minutes_ADV", *_named(S.ADVANCED, "_ADV"), "minutes_USAGE", *_named(S.USAGE, "_USAGE")]
FACTORS = _named(S.FOUR_FACTORS, "_TEAM")
GAMES = [
    "GAME_STATUS", "GAME_TIME_UTC", "HOME_TEAM_ID", "HOME_TEAM_TRICODE", "HOME_TEAM_POINTS", "AWAY_TEAM_ID", "AWAY_TEAM_TRICODE",
    "AWAY_TEAM_POINTS", *(f"REFEREE_{i}_{part}" for part in ("ID", "NAME") for i in (1, 2, 3)),
    "HOME_FLAG", "POINT_MARGIN", "GAME_TOTAL_POINTS",
]
FLAGS = ["HOME_TEAM_WIN_FLAG", "PLAYER_TEAM_WIN_FLAG"]


@query(_stage_sql(BOXES))
def player_table(spark, sf_dir):
    """Three box scores of a game side by side, keys checked 1:1, all their columns."""
    traditional, advanced, usage, _, _ = flat_endpoints(spark, sf_dir)
    return plain(A.player_table(traditional, advanced, usage))


@query(_stage_sql(STAT_COLUMNS, FACTORS))
def team_context(spark, sf_dir):
    traditional, _, _, factors, _ = flat_endpoints(spark, sf_dir)
    return plain(A.with_team_context(payloads.as_player_team(traditional), factors))


@query(_stage_sql(STAT_COLUMNS, GAMES))
def game_metadata(spark, sf_dir):
    traditional, _, _, _, live = flat_endpoints(spark, sf_dir)
    return plain(A.with_game_metadata(payloads.as_player_team(traditional), live))


@query(_stage_sql(STAT_COLUMNS, GAMES, FLAGS))
def outcome_flags(spark, sf_dir):
    traditional, _, _, _, live = flat_endpoints(spark, sf_dir)
    return plain(A.with_outcome(A.with_game_metadata(payloads.as_player_team(traditional), live)))


@query(_stage_sql(BOXES, FACTORS, GAMES, FLAGS))
def assembled_rows(spark, sf_dir):
    """All endpoints to player rows of all columns, the per-team context as one more side of the join."""
    return plain(A.assemble(*flat_endpoints(spark, sf_dir)))


@query(rows_sql())
def day_load(spark, sf_dir):
    """A complete load of all landed dates into a new store, read back with all its columns."""
    store, _ = load_all(spark, sf_dir)
    return plain(store.log())


@query(f"""
select cast({DAY_SQL} as varchar) as game_date, case when bool_or({BAD_SQL}) then 'failed' else 'loaded' end as status,
       cast(case when bool_or({BAD_SQL}) then 0 else sum({PLAYERS}) end as bigint) as rows, '20260314052056' as load_batch_id,
       cast(floor(date_diff('day', date '1990-01-01', {DAY_SQL}) / 7) as integer) as batch_no
from orders group by {DAY_SQL}
""")
def load_ledger(spark, sf_dir):
    store, _ = loaded_store(spark, sf_dir)
    return plain(store.ledger())


@query(f"""
with m as (select cast({DAY_SQL} as varchar) as game_date,
    count(*) filter (where {UNPLAYED_GAME}) as unplayed, count(*) filter (where {REPEATED_PLAYER}) as repeated,
    count(*) filter (where {BROKEN_BOARD}) as broken, count(*) filter (where {UNIDENTIFIED_GAME}) as unidentified,
    count(*) filter (where {NEGATIVE_MINUTES}) as negative, 2 * coalesce(sum({PLAYERS}) filter (where {SHORT_OFFICIALS}), 0) as nulls
  from orders group by {DAY_SQL}),
ok as (select * from m where unplayed + repeated + broken + unidentified = 0),
g as (select game_date, 'scoreboard_payload' as gate, broken as bad_rows from m
  union all select game_date, 'unidentified_game', unidentified from m
  union all select game_date, 'rejected_line', 0 from m
  union all select game_date, 'missing_game', unplayed from m
  union all select game_date, 'repeated_key', repeated from m
  union all select game_date, 'duplicate_row_key', 0 from ok
  union all select game_date, 'null_player_id', 0 from ok
  union all select game_date, 'negative_minutes', negative from ok
  union all select game_date, 'empty', 0 from ok
  union all select game_date, 'null_values', nulls from ok)
select game_date, gate, cast(bad_rows as bigint) as bad_rows, bad_rows = 0 as pass from g
""")
def load_gates(spark, sf_dir):
    _, result = loaded_store(spark, sf_dir)
    return plain(result.gates)


@query(f"""
select cast({DAY_SQL} as varchar) as game_date, column_name, cast(sum({PLAYERS}) as bigint) as null_rows
from orders cross join (values ('REFEREE_3_ID'), ('REFEREE_3_NAME')) as c(column_name)
where {SHORT_OFFICIALS} group by {DAY_SQL}, column_name
""")
def load_null_columns(spark, sf_dir):
    """Why dates failed the null gate: the columns with nulls, per failed date."""
    _, result = loaded_store(spark, sf_dir)
    return plain(result.null_columns)


@query(f"""
select game_date, endpoint, key, cast(2 as bigint) as key_rows from (
  select cast({DAY_SQL} as varchar) as game_date, 'advanced' as endpoint,
    concat(lpad(cast(o_orderkey as varchar), 10, '0'), ', ', o_custkey * 4 + 1, ', ', {HOME_TEAM}) as key,
    row_number() over (partition by {DAY_SQL} order by lpad(cast(o_orderkey as varchar), 10, '0')) as n
  from orders where {REPEATED_PLAYER}) r where n <= 5
""")
def load_repeated_keys(spark, sf_dir):
    """Why dates failed the key gate: five repeated keys of each."""
    _, result = loaded_store(spark, sf_dir)
    return plain(result.repeated_keys)


@query(f"""
select cast({DAY_SQL} as varchar) as game_date, concat('9', o_orderkey) as game_id from orders where {UNPLAYED_GAME}
""")
def load_missing_games(spark, sf_dir):
    """Listed games that no payload answers."""
    _, result = loaded_store(spark, sf_dir)
    return plain(result.missing_games)


SEASON, SEASON_END, EXCLUDED = date(1996, 1, 1), date(2000, 12, 31), [date(1997, 2, 1), date(1998, 8, 3)]
KEPT_SQL = f"select distinct {DAY_SQL} as d from orders where {DAY_SQL} not in (select {DAY_SQL} from orders where {BAD_SQL})"


def _health(spark, sf_dir):
    store, _ = loaded_store(spark, sf_dir)
    return monitoring.data_health(store.log(), SEASON, SEASON_END, EXCLUDED)


@query(f"""
select cast({DAY_SQL} as varchar) as game_date, cast(sum({PLAYERS}) as bigint) as total_rows,
       cast(sum({PLAYERS}) as bigint) as distinct_row_keys,
       cast(0 as bigint) as duplicate_row_keys
from orders where {DAY_SQL} between date '{SEASON}' and date '{SEASON_END}' and {DAY_SQL} in ({KEPT_SQL})
group by {DAY_SQL}
""")
def log_daily_status(spark, sf_dir):
    return plain(_health(spark, sf_dir).status)


@query(f"""
select cast(d as varchar) as game_date from (select cast(unnest(generate_series(timestamp '{SEASON}', timestamp '{SEASON_END}',
  interval 1 day)) as date) as d) c
where d not in ({KEPT_SQL}) and d not in ({", ".join(f"date '{day}'" for day in EXCLUDED)})
""")
def log_missing_days(spark, sf_dir):
    return plain(_health(spark, sf_dir).missing)


AUDIT_DAY = date(1997, 3, 14)
SIDES_SQL = f"""select lpad(cast(o_orderkey as varchar), 10, '0') as game_id,
    case when {at_home("slot")} then {HOME_TEAM} else {AWAY_TEAM} end as player_team_id
  from orders cross join {SLOTS_SQL} where slot <= {PLAYERS} and {DAY_SQL} in ({KEPT_SQL}) and {DAY_SQL}"""


@query(f"""
select game_id, player_team_id, count(*) as player_count from ({SIDES_SQL} between date '{SEASON}' and date '{SEASON_END}') s
group by 1, 2 having count(*) < 5
""")
def log_low_player_teams(spark, sf_dir):
    """The integrity audit over a range of stored dates; sides have two to seven players."""
    store, _ = loaded_store(spark, sf_dir)
    return plain(monitoring.game_integrity(store.log(), SEASON, SEASON_END).low_team_players)


@query(f"""
select game_id, count(*) as total_players from ({SIDES_SQL} between date '{SEASON}' and date '{SEASON_END}') s
group by 1 having count(*) < 10
""")
def log_low_player_games(spark, sf_dir):
    """The same over games, which have four to fourteen players."""
    store, _ = loaded_store(spark, sf_dir)
    return plain(monitoring.game_integrity(store.log(), SEASON, SEASON_END).low_game_players)


@query(f"""
select game_id, count(*) as total_players from ({SIDES_SQL} = date '{AUDIT_DAY}') s group by 1 having count(*) < 10
""")
def log_low_player_day(spark, sf_dir):
    """The audit of one stored date, which is how it runs day by day."""
    store, _ = loaded_store(spark, sf_dir)
    return plain(monitoring.game_integrity(store.log(), AUDIT_DAY).low_game_players)


@query(f"""
select cast(max(d) as varchar) as last_game_date, '{SEASON_END}' as expected_latest,
       date_diff('day', max(d), date '{SEASON_END}') as days_behind,
       count(*) filter (where d <= date '{SEASON_END}') as total_rows,
       count(distinct o_orderkey) filter (where d <= date '{SEASON_END}') as total_games,
       count(distinct player) filter (where d <= date '{SEASON_END}') as unique_players,
       count(distinct d) filter (where d <= date '{SEASON_END}') as partition_count
from (select {DAY_SQL} as d, o_orderkey, {player_id("slot")} as player from orders cross join {SLOTS_SQL} where slot <= {PLAYERS}) t where d >= date '{SEASON}' and d in ({KEPT_SQL})
""")
def log_command_center(spark, sf_dir):
    store, _ = loaded_store(spark, sf_dir)
    figures = monitoring.command_center(store.log(), SEASON, SEASON_END)
    return plain(figures.withColumn("days_behind", F.col("days_behind").cast("bigint")))


@query(rows_sql())
def export_and_read(spark, sf_dir):
    """The stored log exported as CSV with its game ids cut to numbers, and read back with all its columns."""
    store, _ = loaded_store(spark, sf_dir)
    path = scratch_folder(spark, "export")
    write_export(store.log().withColumn("GAME_ID", F.col("GAME_ID").cast("bigint").cast("string")), path, "gzip")
    return plain(read_export(spark, path))


@query("""
select o_orderstatus as status, count(*) as days, string_agg(cast(d as varchar), ',' order by d) as day_list
from (select distinct o_orderstatus, cast(o_orderdate as date) as d from orders) s group by 1
""")
def ledger_summary(spark, sf_dir):
    """Dates by status, from a ledger that holds a date many times."""
    ledger = _daily_orders(spark, sf_dir).withColumnRenamed("o_orderstatus", "STATUS")
    return plain(audits.run_summary(ledger).withColumn("day_list", F.array_join("day_list", ",")))


@query("""
with r as (select cast(date_trunc('month', o_orderdate) as date) as d, '1' as run,
    case when bool_or(o_orderpriority = '1-URGENT' and o_orderkey % 7 = 0) then 'failed' else 'loaded' end as s
  from orders group by 1
  union all select cast(date_trunc('month', o_orderdate) as date), '2', 'loaded' from orders
  where year(o_orderdate) >= 1996 group by 1)
select cast(d as varchar) as game_date, arg_max(s, run) as status, max(run) as load_batch_id from r group by d
""")
def ledger_current(spark, sf_dir):
    """The state of each month after a first run, in which some fail, and a second that repairs the later years."""
    return plain(audits.current_status(_two_runs(spark, sf_dir)))


@query("""
with r as (select cast(date_trunc('month', o_orderdate) as date) as d, '1' as run,
    case when bool_or(o_orderpriority = '1-URGENT' and o_orderkey % 7 = 0) then 'failed' else 'loaded' end as s
  from orders group by 1
  union all select cast(date_trunc('month', o_orderdate) as date), '2', 'loaded' from orders
  where year(o_orderdate) >= 1996 group by 1)
select run as load_batch_id, s as status, count(*) as days, string_agg(cast(d as varchar), ',' order by d) as day_list
from r group by 1, 2
""")
def ledger_by_run(spark, sf_dir):
    """The summary of each run on its own."""
    summary = audits.run_summary(_two_runs(spark, sf_dir), run="LOAD_BATCH_ID")
    return plain(summary.withColumn("day_list", F.array_join("day_list", ",")))


def _two_runs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("GAME_DATE", F.expr("cast(trunc(o_orderdate, 'MM') as date)"))
    first = orders.groupBy("GAME_DATE").agg(F.max((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 7 == 0)).alias("bad"))
    runs = first.select("GAME_DATE", F.when(F.col("bad"), "failed").otherwise("loaded").alias("STATUS"), F.lit("1").alias("LOAD_BATCH_ID"))
    second = orders.where("year(GAME_DATE) >= 1996").select("GAME_DATE", F.lit("loaded").alias("STATUS"), F.lit("2").alias("LOAD_BATCH_ID"))
    return runs.unionByName(second.distinct())
