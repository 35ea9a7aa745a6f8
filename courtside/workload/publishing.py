"""Audited publishes, loads of short ranges, rejected lines, the audit state, and the checks before a run."""

import uuid
from datetime import date

from pyspark.sql import functions as F

from courtside import schema as S
from courtside.functions import calendar
from courtside.operators import audits, gates
from courtside.plans import monitoring
from courtside.plans.day_load import load_days
from courtside.session import scratch_folder
from courtside.sources import store as stores
from courtside.sources.landing import Landing, rejected
from courtside.sources.published import PublishedTable, expected_counts
from courtside.sources.store import Store
from courtside.workload.landed import (
    BROKEN_BOARD,
    DATED,
    DAY_SQL,
    INGESTED,
    LINES_PER_FILE,
    landing_of,
    loaded_store,
    new_store,
    payloads_of,
    rows_sql,
)
from courtside.workload.loading import EXCLUDED, SEASON, SEASON_END
from courtside.workload.registry import ORACLES, plain, query, table

VERSIONED = S.struct_of("""
o_orderkey bigint
o_orderstatus string
version int
GAME_DATE date
""")


@query(f"""
with whole as (select {DAY_SQL} as d from orders group by 1 having count(*) filter (where o_custkey % 10 = 0) = 0)
select cast({DAY_SQL} as varchar) as game_date, o_orderkey, o_orderstatus,
       case when year(o_orderdate) >= 1997 and {DAY_SQL} in (select d from whole) then 2 else 1 end as version
from orders
""")
def audited_publish(spark, sf_dir):
    """All dates published, then those from 1997 on again, of which the second time some orders are lost on the way.

    A date whose count then fails goes on serving its first version.
    """
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "o_custkey", "1 as version", "cast(o_orderdate as date) as GAME_DATE"
    )
    log = PublishedTable(spark, f"orders_log_{uuid.uuid4().hex}", scratch_folder(spark, "orders-log"), VERSIONED)
    log.create()
    log.publish(rows.repartition("GAME_DATE"), expected_counts(rows), "1")
    again = rows.where("year(GAME_DATE) >= 1997").withColumn("version", F.lit(2))
    log.publish(again.where("o_custkey % 10 <> 0").repartition("GAME_DATE"), expected_counts(again), "2")
    return plain(log.rows())


WEEK = date(1997, 3, 10), date(1997, 3, 16)
MONTH = date(1997, 2, 1), date(1997, 2, 28)
_runs: dict = {}


def _ranged_load(spark, sf_dir, first, last):
    """A load of a short range into a store of its own, once per session and folder of tables."""
    key = (spark.conf.get("spark.app.id"), sf_dir, first)
    if key not in _runs:
        store, texts = new_store(spark), [day.strftime(calendar.DATE_TEXT) for day in (first, last)]
        _runs[key] = store, load_days(landing_of(spark, sf_dir), store, *texts, INGESTED, max_days=(last - first).days + 1)
    return _runs[key]


@query(rows_sql(where=f"{DAY_SQL} between date '{WEEK[0]}' and date '{WEEK[1]}'"))
def week_load(spark, sf_dir):
    """The usual run of seven days: only their folders of the landing are read, and gates ride on the write."""
    return plain(_ranged_load(spark, sf_dir, *WEEK)[0].log())


@query(
    f"select * from ({ORACLES['load_gates']}) g where cast(game_date as date) between date '{MONTH[0]}' and date '{MONTH[1]}'"
)
def observed_gates(spark, sf_dir):
    """The gate report of a month whose rows were counted while they were written; some of its dates lack officials."""
    return plain(_ranged_load(spark, sf_dir, *MONTH)[1].gates)


# Rejected lines: every so manieth line of an endpoint is spoilt in one of four ways.
SPOILT = 40
ENDPOINT_SQL = "(o_orderkey // 40) % 6"
KINDS = ("malformed", "no date", "no game id", "no payload")


@query(f"""
with o as (select *, {ENDPOINT_SQL} as e, o_orderkey % {SPOILT} as k from orders where o_orderkey % {SPOILT} < 4)
select [{", ".join(f"'{n}'" for n in DATED)}][e + 1] as endpoint,
       case when k <> 1 then cast({DAY_SQL} as varchar) end as game_date,
       case when e > 0 and k <> 2 then lpad(cast(o_orderkey as varchar), 10, '0') end as game_id,
       case when e = 0 and k = 3 then 'no games' else [{", ".join(f"'{n}'" for n in KINDS)}][k + 1] end as reason
from o where not (e = 0 and k = 2) and not (e = 0 and {BROKEN_BOARD})
union all select 'scoreboard', cast({DAY_SQL} as varchar), null, 'no games' from orders where {BROKEN_BOARD}
union all select 'player_info', null, null, case when c_custkey % 50 = 0 then 'malformed' else 'no player id' end
from customer where c_custkey % 50 < 2
""")
def rejected_lines(spark, sf_dir):
    """What is rejected, and why, of a landing with spoilt lines in each endpoint, in files that hold all dates."""
    root = scratch_folder(spark, "spoilt")
    mark = F.coalesce(F.col("key") % SPOILT, F.lit(-1))
    for number, name in enumerate(DATED):
        payload = payloads_of(spark, sf_dir, repeats=False, names=[name])[name]
        if name == "scoreboard":
            payload = payload.withColumn("game_id", F.expr("scoreboard.games[0].gameId"))
        own = F.coalesce(F.floor(F.col("key") / SPOILT) % len(DATED) == number, F.lit(False))
        body = [c for c in payload.columns if c not in ("game_date", "game_id")][0]
        names = ["game_date", body] if name == "scoreboard" else ["game_date", "game_id", body]
        keyed = payload.withColumn("key", F.col("game_id").cast("bigint"))
        fields = {
            "game_date": F.when(~(own & (mark == 1)), F.col("game_date")),
            "game_id": F.when(~(own & (mark == 2)), F.col("game_id")),
            body: F.when(~(own & (mark == 3)), F.col(body)),
        }
        text = F.to_json(F.struct(*[fields[n].alias(n) for n in names]))
        line = F.when(own & (mark == 0), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
        lines = keyed.select(line.alias("value")).write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        lines.option("maxRecordsPerFile", LINES_PER_FILE).text(f"{root}/{name}")
    people = table(spark, sf_dir, "customer")
    info = F.to_json(F.struct(F.when(F.col("c_custkey") % 50 != 1, F.col("c_custkey")).alias("PLAYER_ID"), F.col("c_mktsegment").alias("POSITION")))
    info = F.when(F.col("c_custkey") % 50 == 0, F.substring(info, F.lit(1), F.length(info) - 1)).otherwise(info)
    people.select(info.alias("value")).write.text(f"{root}/player_info")
    landing = Landing(spark, root)
    found = rejected(landing.checked_scoreboard(), "scoreboard", "game_date", "game_id")
    for name in DATED[1:]:
        found = found.unionByName(rejected(landing.checked(name), name, "game_date", "game_id"))
    found = found.unionByName(rejected(landing.checked_info(), "player_info"))
    return plain(found.select("endpoint", "GAME_DATE", "GAME_ID", "reason"))


# The audit state gives what the scans of the log give, so it has their SQL.


@query(ORACLES["log_daily_status"])
def state_daily_status(spark, sf_dir):
    store, _ = loaded_store(spark, sf_dir)
    return plain(monitoring.data_health_of(store.state(), SEASON, SEASON_END, EXCLUDED).status)


@query(ORACLES["log_missing_days"])
def state_missing_days(spark, sf_dir):
    store, _ = loaded_store(spark, sf_dir)
    return plain(monitoring.data_health_of(store.state(), SEASON, SEASON_END, EXCLUDED).missing)


@query(ORACLES["log_low_player_teams"])
def state_low_player_teams(spark, sf_dir):
    store, _ = loaded_store(spark, sf_dir)
    return plain(monitoring.game_counts_of(store.state(), SEASON, SEASON_END)[1])


@query(ORACLES["log_low_player_games"])
def state_low_player_games(spark, sf_dir):
    store, _ = loaded_store(spark, sf_dir)
    return plain(monitoring.game_counts_of(store.state(), SEASON, SEASON_END)[2])


@query(f"""
select cast({DAY_SQL} as varchar) as game_date, o_orderkey % 3 as whole, count(*) as total_rows, count(distinct o_custkey) as players,
       count(distinct o_orderpriority) as teams
from orders group by 1, 2
""")
def game_state(spark, sf_dir):
    """The state of a log of orders: customers are players, priorities are teams, three games a date."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderdate as date) as GAME_DATE", "o_orderkey % 3 as GAME_ID", "o_orderpriority", "o_custkey", "o_orderkey"
    )
    state = audits.game_state(rows, team="o_orderpriority", player="o_custkey", key="o_orderkey")
    games = state.where("whole_game and row_keys = total_rows")
    return plain(games.select("GAME_DATE", F.col("GAME_ID").alias("whole"), "total_rows", "players", "teams"))


@query("""
with r as (select cast(o_orderdate as date) as d, lpad(cast(o_orderkey % 9 as varchar), 2, '0') as run, o_orderstatus as s,
    count(*) as n from orders group by 1, 2, 3),
one as (select d, run, max(s) as s, max(n) as n from r group by 1, 2)
select cast(d as varchar) as game_date, arg_max(s, run) as status, cast(arg_max(n, run) as bigint) as rows, max(run) as load_batch_id,
       cast(0 as integer) as batch_no
from one group by d
""")
def compacted_ledger(spark, sf_dir):
    """The state of each date from a ledger of nine runs that was compacted twice on the way."""
    one = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderdate as date) as GAME_DATE", "o_orderstatus as STATUS", "lpad(cast(o_orderkey % 9 as string), 2, '0') as LOAD_BATCH_ID"
    )
    one = one.groupBy("GAME_DATE", "LOAD_BATCH_ID", "STATUS").agg(F.count(F.lit(1)).alias("n"))
    one = one.groupBy("GAME_DATE", "LOAD_BATCH_ID").agg(F.max("STATUS").alias("STATUS"), F.max("n").alias("ROWS"))
    one = one.withColumn("BATCH_NO", F.lit(0))
    store = Store(spark, scratch_folder(spark, "ledger"))
    for first, last in (("00", "02"), ("03", "06"), ("07", "08")):
        store.append_ledger(one.where(F.col("LOAD_BATCH_ID").between(first, last)))
        if last != "08":
            store.compact_ledger()
    return plain(store.current_ledger())


@query("""
select o_orderkey, cast(asked as integer) as asked_days, asked <= 7 as allowed from (
  select o_orderkey, o_orderkey % 12 + 1 - cast(date '1996-02-29' between f and l as integer) - cast(date '1997-01-01' between f and l as integer)
    as asked
  from (select o_orderkey, cast(o_orderdate as date) as f, cast(o_orderdate as date) + cast(o_orderkey % 12 as integer) as l from orders) r) a
""")
def day_cap(spark, sf_dir):
    """A run asked for from each order's date on, for up to twelve days: how many it has and whether it is allowed."""
    first = F.to_date("o_orderdate")
    last = F.date_add(first, (F.col("o_orderkey") % 12).cast("int"))
    asked = calendar.asked_days(first, last, [date(1996, 2, 29), date(1997, 1, 1)])
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", asked.alias("asked_days"), (asked <= calendar.MAX_DAYS_PER_RUN).alias("allowed")
    )


@query("""
select distinct concat('n_', o_orderpriority) as column_name, 'duplicate' as problem, cast(2 as integer) as times from orders
union all select 'ROW_KEY', 'missing', cast(0 as integer)
union all select 'n_' || s, 'missing', cast(0 as integer) from (values ('0-NONE'), ('6-EVER')) as v(s)
where 'n_' || s not in (select 'n_' || o_orderpriority from orders)
union all select 'GAME_DATE', 'duplicate', cast(2 as integer)
""")
def column_problems(spark, sf_dir):
    """Missing and repeated columns of a frame whose columns come of the data: counts by priority, joined to themselves."""
    by_day = table(spark, sf_dir, "orders").withColumn("GAME_DATE", F.to_date("o_orderdate")).withColumn(
        "name", F.concat(F.lit("n_"), F.col("o_orderpriority"))
    )
    wide = by_day.groupBy("GAME_DATE").pivot("name").count()
    twice = wide.alias("one").join(wide.alias("again"), F.col("one.GAME_DATE") == F.col("again.GAME_DATE"))
    return gates.column_report(twice, ["GAME_DATE", "ROW_KEY", "n_0-NONE", "n_6-EVER"])


@query("""
with days as (select cast(unnest(generate_series(timestamp '1995-01-01', timestamp '1996-12-31', interval 1 day)) as date) as d),
c as (select cast(o_orderdate as date) as d, count(*) as n from orders where o_orderstatus = 'P' group by 1)
select cast(d as varchar) as game_date, 'empty' as gate, cast(n is null as bigint) as bad_rows, n is not null as pass
from days left join c using (d)
""")
def empty_days(spark, sf_dir):
    """The gate for empty frames over two years of dates, of which some have no pending order."""
    rows = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").selectExpr(
        "cast(o_orderdate as date) as GAME_DATE", "cast(o_orderkey as string) as ROW_KEY", "o_custkey as PLAYER_ID", "1L as minutes_SECONDS"
    )
    days = calendar.run_days(spark, date(1995, 1, 1), date(1996, 12, 31))
    return plain(gates.gate_report(gates.day_counts(rows), days).where("gate = 'empty'"))


@query(f"""
select cast({DAY_SQL} as varchar) as game_date, count(*) as rows, count(*) - count(case when o_totalprice > 100000 then o_custkey end) as customer,
       count(*) - count(nullif(o_orderstatus, 'O')) as status
from orders group by 1
""")
def footer_statistics(spark, sf_dir):
    """Rows and nulls per date of a stored table of orders, from the footers of its files."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "case when o_totalprice > 100000 then o_custkey end as customer", "nullif(o_orderstatus, 'O') as status", "cast(o_orderdate as date) as GAME_DATE"
    )
    path = scratch_folder(spark, "orders-by-date")
    stores.replace_days(rows.repartition(spark.sparkContext.defaultParallelism, "GAME_DATE"), path)
    return plain(stores.footer_counts(spark, path, rows.schema, ["customer", "status"]))
