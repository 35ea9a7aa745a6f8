"""Aggregates, audits, gates and calendars on the given tables."""

from datetime import date

from pyspark.sql import functions as F

from courtside.functions import calendar
from courtside.functions import columns as C
from courtside.operators import audits, gates
from courtside.workload.registry import plain, query, table

FIRST, LAST = date(1995, 2, 1), date(2001, 6, 30)
EXCLUDED = [date(1995, 2, 3), date(1999, 12, 24), date(2001, 6, 30)]
EXCLUDED_SQL = ", ".join(f"date '{day}'" for day in EXCLUDED)
WINDOW_SQL = f"between date '{FIRST}' and date '{LAST}'"


def _shipped(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.to_date("l_shipdate").alias("GAME_DATE"),
        C.row_key(F.col("l_orderkey"), F.col("l_suppkey")).alias("ROW_KEY"),
        "l_orderkey", "l_suppkey", "l_linenumber",
    )


def _status(spark, sf_dir):
    rows = audits.between_days(_shipped(spark, sf_dir), FIRST, LAST)
    return audits.daily_status(rows.withColumn("ROW_KEY", C.row_key(F.col("l_suppkey"), F.col("l_linenumber"))))


STATUS_SQL = f"""
select cast(cast(l_shipdate as date) as varchar) as game_date, count(*) as total_rows,
       count(distinct concat(l_suppkey, '_', l_linenumber)) as distinct_row_keys,
       count(*) - count(distinct concat(l_suppkey, '_', l_linenumber)) as duplicate_row_keys
from lineitem where cast(l_shipdate as date) {WINDOW_SQL} group by cast(l_shipdate as date)
"""


@query(STATUS_SQL + " order by 1")
def daily_status(spark, sf_dir):
    return plain(_status(spark, sf_dir))


@query(f"select * from ({STATUS_SQL}) s where duplicate_row_keys > 0")
def duplicate_days(spark, sf_dir):
    return plain(audits.days_with_duplicates(_status(spark, sf_dir)))


@query(f"""
select case when duplicate_row_keys > 0 then 'failed' else 'loaded' end as status, count(*) as days,
       string_agg(game_date, ',' order by game_date) as day_list
from ({STATUS_SQL}) s group by 1
""")
def run_summary(spark, sf_dir):
    ledger = _status(spark, sf_dir).select(
        "GAME_DATE", F.when(F.col("duplicate_row_keys") > 0, "failed").otherwise("loaded").alias("STATUS")
    )
    return plain(audits.run_summary(ledger).withColumn("day_list", F.array_join("day_list", ",")))


SEASON, SEASON_END = date(1994, 12, 1), date(2001, 12, 31)


@query(f"""
select cast(d as varchar) as game_date
from (select cast(unnest(generate_series(timestamp '{SEASON}', timestamp '{SEASON_END}', interval 1 day)) as date) as d) c
where d not in ({EXCLUDED_SQL}) and d not in (select cast(o_orderdate as date) from orders)
""")
def missing_dates(spark, sf_dir):
    """Calendar days without an order that are not excluded."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("GAME_DATE"))
    return plain(audits.missing_days(days, SEASON, SEASON_END, EXCLUDED))


@query(f"""
select cast(d as varchar) as game_date
from (select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as date) as d from orders) c
where d not in ({EXCLUDED_SQL})
""")
def run_calendar(spark, sf_dir):
    """All days the orders span, without the excluded ones."""
    bounds = table(spark, sf_dir, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    days = calendar.calendar_days(bounds, F.col("first"), F.col("last"))
    return plain(calendar.without_days(days, EXCLUDED))


@query("""
select cast(d as varchar) as game_date, cast(floor((row_number() over (order by d) - 1) / 7) as integer) as batch_no
from (select distinct cast(o_orderdate as date) as d from orders) days
""")
def date_batches(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("GAME_DATE"))
    return plain(calendar.number_batches(days))


@query("""
select event_id, cast(cast((ts at time zone 'UTC') at time zone 'America/New_York' as date) - 1 as varchar) as run_date
from events
""")
def auto_yesterday(spark, sf_dir):
    return plain(
        table(spark, sf_dir, "events").select("event_id", calendar.schedule_yesterday(F.col("ts")).alias("run_date"))
    )


@query("""
select l_orderkey, count(distinct l_linestatus) as team_count from lineitem
group by l_orderkey having count(distinct l_linestatus) <> 2
""")
def team_count_audit(spark, sf_dir):
    return audits.games_without_two_teams(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linestatus")


@query("""
select l_orderkey, l_linestatus, count(distinct l_suppkey) as player_count from lineitem
group by l_orderkey, l_linestatus having count(distinct l_suppkey) < 5
""")
def low_player_team(spark, sf_dir):
    return audits.teams_with_few_players(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linestatus", "l_suppkey")


@query("""
select l_orderkey, count(distinct l_suppkey) as total_players from lineitem
group by l_orderkey having count(distinct l_suppkey) < 10
""")
def low_player_game(spark, sf_dir):
    return audits.games_with_few_players(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey")


@query("""
select o_orderkey, o_custkey, o_orderstatus, l_suppkey from orders left join lineitem on o_orderkey = l_orderkey
where l_orderkey is null order by o_orderkey limit 20
""")
def corrupted_rows(spark, sf_dir):
    """The first twenty rows without a line; the limit is the report's own."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    rows = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
    return audits.corrupted_rows(rows, ["l_orderkey", "l_suppkey"], ["o_orderkey"]).drop("l_orderkey")


@query(f"""
select cast(max(d) as varchar) as last_game_date, '{LAST}' as expected_latest,
       date_diff('day', max(d), date '{LAST}') as days_behind,
       count(*) filter (where d <= date '{LAST}') as total_rows,
       count(distinct l_orderkey) filter (where d <= date '{LAST}') as total_games,
       count(distinct l_suppkey) filter (where d <= date '{LAST}') as unique_players,
       count(distinct d) filter (where d <= date '{LAST}') as partition_count
from (select cast(l_shipdate as date) as d, l_orderkey, l_suppkey from lineitem) t where d >= date '{FIRST}'
""")
def command_center(spark, sf_dir):
    figures = audits.command_center(_shipped(spark, sf_dir), FIRST, LAST, "GAME_DATE", "l_orderkey", "l_suppkey")
    return plain(figures.withColumn("days_behind", F.col("days_behind").cast("bigint")))


@query("""
with j as (select o_orderkey, o_custkey, nullif(o_orderstatus, 'P') as o_orderstatus, l_suppkey, l_quantity, l_shipdate
           from orders left join lineitem on o_orderkey = l_orderkey)
select 'o_orderkey' as column_name, count(*) - count(o_orderkey) as null_rows from j
union all select 'o_custkey', count(*) - count(o_custkey) from j
union all select 'o_orderstatus', count(*) - count(o_orderstatus) from j
union all select 'l_suppkey', count(*) - count(l_suppkey) from j
union all select 'l_quantity', count(*) - count(l_quantity) from j
union all select 'l_shipdate', count(*) - count(l_shipdate) from j
""")
def null_profile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "nullif(o_orderstatus, 'P') as o_orderstatus"
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_shipdate")
    joined = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left").drop("l_orderkey")
    return gates.null_profile(joined)


GATED_SQL = """
select cast(l_shipdate as date) as d, concat(l_orderkey, '_', l_suppkey) as k,
       case when l_quantity < 50 or l_tax > 0.01 then l_suppkey end as p, l_quantity - 2 as s, nullif(l_returnflag, 'N') as r
from lineitem
"""


@query(f"""
with g as ({GATED_SQL}),
c as (select cast(d as varchar) as game_date, count(*) - count(distinct k) as dup, count(*) - count(p) as np,
             count(*) filter (where s < 0) as neg, count(*) - count(p) + count(*) - count(r) as nulls
      from g group by d)
select game_date, 'duplicate_row_key' as gate, dup as bad_rows, dup = 0 as pass from c
union all select game_date, 'null_player_id', np, np = 0 from c
union all select game_date, 'negative_minutes', neg, neg = 0 from c
union all select game_date, 'empty', 0, true from c
union all select game_date, 'null_values', nulls, nulls = 0 from c
""")
def gate_report(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "to_date(l_shipdate) as GAME_DATE", "concat(l_orderkey, '_', l_suppkey) as ROW_KEY",
        "case when l_quantity < 50 or l_tax > 0.01 then l_suppkey end as PLAYER_ID",
        "l_quantity - 2 as minutes_SECONDS", "nullif(l_returnflag, 'N') as flag",
    )
    gates.check_columns(rows.columns)
    return plain(gates.gate_report(gates.day_counts(rows)))


@query("""
select row_key, count(*) as key_rows from (select concat(l_orderkey, '_', l_suppkey) as row_key from lineitem) k
group by row_key having count(*) > 1 order by row_key limit 5
""")
def duplicate_examples(spark, sf_dir):
    """The first five repeated row keys; the limit is the report's own."""
    return plain(gates.duplicate_examples(_shipped(spark, sf_dir)))
