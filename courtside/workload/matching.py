"""Joins, outcome flags and set differences on the given tables."""

from pyspark.sql import functions as F

from courtside.functions import columns as C
from courtside.operators import audits, joins, outcome
from courtside.plans import assemble as A
from courtside.sources.arenas import ARENAS, arena_rows
from courtside.workload.projections import STAMP
from courtside.workload.registry import plain, query, table

LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
SIDES = """select l_orderkey, sum(case when l_linestatus = 'O' then l_quantity end) as h,
                  sum(case when l_linestatus <> 'O' then l_quantity end) as a from lineitem group by l_orderkey"""


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        *LINE, "l_linestatus", "l_quantity", (F.col("l_linestatus") == "O").alias("home_flag")
    )


def side_outcome_of(lines):
    """Win flags of every line from the summed quantities of its order's two sides."""
    flagged = outcome.with_outcome(lines, ["l_orderkey"], "l_linestatus", "l_quantity", "home_flag")
    return flagged.select(
        *LINE,
        "home_flag",
        F.col("HOME_TEAM_WIN_FLAG").alias("home_team_win_flag"),
        F.col("PLAYER_TEAM_WIN_FLAG").alias("player_team_win_flag"),
    )


@query("""
select l_orderkey, l_linestatus, cast(sum(l_quantity) as bigint) as team_points
from lineitem group by l_orderkey, l_linestatus
""")
def team_points(spark, sf_dir):
    points = outcome.team_points(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linestatus", "l_quantity")
    return points.select("l_orderkey", "l_linestatus", F.col("TEAM_POINTS").cast("bigint").alias("team_points"))


@query(f"""select l_orderkey, cast(h as bigint) as home_points, cast(a as bigint) as away_points from ({SIDES}) s""")
def game_scores(spark, sf_dir):
    scores = outcome.game_scores(_lines(spark, sf_dir), ["l_orderkey"], "l_linestatus", "l_quantity", "home_flag")
    return scores.select(
        "l_orderkey",
        F.col("HOME_POINTS").cast("bigint").alias("home_points"),
        F.col("AWAY_POINTS").cast("bigint").alias("away_points"),
    )


@query(f"""
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linestatus = 'O' as home_flag,
       coalesce(h > a, false) as home_team_win_flag,
       (l_linestatus = 'O') = coalesce(h > a, false) as player_team_win_flag
from lineitem join ({SIDES}) s using (l_orderkey)
""")
def side_outcome(spark, sf_dir):
    return side_outcome_of(_lines(spark, sf_dir))


@query(f"""
select l_orderkey, l_partkey, l_suppkey, l_linenumber,
       cast(case when l_linestatus = 'O' then h - a else a - h end as bigint) as point_margin,
       cast(h + a as bigint) as game_total_points
from lineitem join ({SIDES}) s using (l_orderkey)
""")
def signed_margin(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    scores = outcome.game_scores(lines, ["l_orderkey"], "l_linestatus", "l_quantity", "home_flag")
    joined = joins.join_to_one(lines, scores, ["l_orderkey"])
    home, away = F.col("HOME_POINTS"), F.col("AWAY_POINTS")
    return joined.select(
        *LINE,
        C.signed_margin(F.col("home_flag"), home, away).cast("bigint").alias("point_margin"),
        C.game_total(home, away).cast("bigint").alias("game_total_points"),
    )


_STAT_SQL = """select cast(l_shipdate as date) as d, l_orderkey, l_suppkey, l_partkey, max(l_returnflag) as r,
  max(l_linestatus) as s, cast(sum(l_quantity) as bigint) as q from lineitem where {} group by all"""


@query(f"""
select cast(t.d as varchar) as game_date, t.l_orderkey as game_id, t.l_suppkey as player_id,
       t.l_partkey as player_team_id, t.r as player_name, t.s as player_team_tricode,
       t.q as quantity, a.q as quantity_adv, u.q as quantity_usage
from ({_STAT_SQL.format("true")}) t
left join ({_STAT_SQL.format("l_quantity > 25")}) a
  on t.d = a.d and t.l_orderkey = a.l_orderkey and t.l_suppkey = a.l_suppkey and t.l_partkey = a.l_partkey
left join ({_STAT_SQL.format("l_tax > 0.02")}) u
  on t.d = u.d and t.l_orderkey = u.l_orderkey and t.l_suppkey = u.l_suppkey and t.l_partkey = u.l_partkey
""")
def suffix_join(spark, sf_dir):
    """Three statistics tables of the same keys side by side; their groups make the keys unique."""
    lines = table(spark, sf_dir, "lineitem")

    def stats(kept):
        return (
            lines.where(kept)
            .groupBy(
                F.to_date("l_shipdate").alias("GAME_DATE"), F.col("l_orderkey").alias("GAME_ID"),
                F.col("l_suppkey").alias("PLAYER_ID"), F.col("l_partkey").alias("TEAM_ID"),
            )
            .agg(
                F.max("l_returnflag").alias("PLAYER_NAME"), F.max("l_linestatus").alias("TEAM_TRICODE"),
                F.sum("l_quantity").cast("bigint").alias("quantity"),
            )
        )

    return plain(A.player_table(stats("true"), stats("l_quantity > 25"), stats("l_tax > 0.02"), checked=True))


@query("""
select l_orderkey, l_partkey, l_suppkey, l_linenumber, o_orderstatus, o_orderpriority, s_name, n_name
from lineitem left join orders on l_orderkey = o_orderkey
left join supplier on l_suppkey = s_suppkey left join nation on s_nationkey = n_nationkey
""")
def m1_enrich(spark, sf_dir):
    """Lines with their order by a guarded m:1 join, then two dimensions likewise."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_orderpriority"
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    lines = table(spark, sf_dir, "lineitem").select(*LINE)
    ordered = joins.guarded_join(lines, orders, ["l_orderkey"], "m:1")
    supplied = joins.guarded_join(ordered, suppliers, ["l_suppkey"])
    return joins.guarded_join(supplied, nations, ["s_nationkey"]).drop("s_nationkey")


def arenas_sql() -> str:
    rows = []
    for line in ARENAS.strip().splitlines():
        team, *texts = line.split("|")
        rows.append("(" + ", ".join([team, *(f"'{text}'" for text in texts)]) + ")")
    return f"(values {', '.join(rows)}) as arenas(team_id, tricode, arena_name, arena_city, arena_state)"


@query(f"""
select o_orderkey, 2 * o_custkey as player_id, 1610612737 + o_custkey % 31 as home_team_id,
       c_mktsegment as position, c_name as height, cast(c_nationkey as varchar) as exp,
       arena_name, arena_city, arena_state
from orders left join customer on 2 * o_custkey = c_custkey
left join {arenas_sql()} on team_id = 1610612737 + o_custkey % 31
""")
def dimension_enrichment(spark, sf_dir):
    """Player attributes and venues; some players and one team are unknown and stay null."""
    players = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as PLAYER_ID", "c_mktsegment as POSITION", "c_name as HEIGHT", "cast(c_nationkey as string) as EXP"
    )
    arenas = arena_rows(spark, STAMP).drop("LAST_UPDATED_UTC")
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "2 * o_custkey as PLAYER_ID", "1610612737 + o_custkey % 31 as HOME_TEAM_ID"
    )
    return plain(A.with_dimensions(rows, players, arenas))


@query("""
select l_orderkey, l_suppkey, count(*) as key_rows from lineitem group by l_orderkey, l_suppkey having count(*) > 1
""")
def cardinality_report(spark, sf_dir):
    return joins.cardinality_report(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_suppkey"])


@query("""
select distinct o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)
""")
def missing_members(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.missing_from(table(spark, sf_dir, "orders"), lines, ["o_orderkey"])


@query("""
with wanted as (select distinct 2 * l_partkey as k from lineitem),
     known as (select p_partkey as k from part)
select (select count(*) from wanted) as season_players, (select count(*) from known) as dimension_players,
       (select count(*) from wanted where k not in (select k from known)) as missing_players,
       (select count(*) from known where k not in (select k from wanted)) as extra_players
""")
def season_coverage(spark, sf_dir):
    season = table(spark, sf_dir, "lineitem").selectExpr("2 * l_partkey as PLAYER_ID")
    dimension = table(spark, sf_dir, "part").selectExpr("p_partkey as PLAYER_ID")
    return audits.season_coverage(season, dimension)


@query("""
select distinct 2 * o_custkey as player_id from orders
where 2 * o_custkey not in (select c_custkey from customer)
""")
def unmatched_after_join(spark, sf_dir):
    players = table(spark, sf_dir, "orders").selectExpr("2 * o_custkey as PLAYER_ID")
    known = table(spark, sf_dir, "customer").selectExpr("c_custkey as PLAYER_ID")
    return plain(A.unmatched_players(players, known))


@query("""
select distinct 2 * l_partkey as k from lineitem where 2 * l_partkey not in (select p_partkey from part) order by k
""")
def ordered_missing_members(spark, sf_dir):
    season = table(spark, sf_dir, "lineitem").selectExpr("2 * l_partkey as k")
    known = table(spark, sf_dir, "part").selectExpr("p_partkey as k")
    return joins.missing_from(season, known, ["k"]).orderBy("k")
