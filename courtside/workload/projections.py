"""Projections and scalar derivations on the given tables."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from courtside.functions import columns as C
from courtside.operators import payloads
from courtside.operators.shape import fill_missing, lock_schema, stack
from courtside.schema import box_score_schema, struct_of
from courtside.sources.landing import season_player_ids
from courtside.workload.registry import dealt, plain, query, table

ENVELOPE = "boxScoreTraditional"
SMALL_BOX = box_score_schema(ENVELOPE, struct_of("points bigint\nplusMinusPoints double"))


@query("""
select cast(cast(l_shipdate as date) as varchar) as game_date, cast(l_orderkey as varchar) as game_id,
       l_partkey as player_id, concat(l_returnflag, ' ', l_linestatus) as player_name,
       l_suppkey as team_id, concat('S', l_suppkey) as team_tricode,
       cast(l_quantity as bigint) as points, l_discount as plusminuspoints
from lineitem
union all
select cast(cast(l_shipdate as date) as varchar), cast(l_orderkey as varchar),
       null, concat('Part ', l_partkey), l_suppkey, concat('S', l_suppkey), null, l_tax
from lineitem
union all
select cast(cast(l_shipdate as date) as varchar), cast(l_orderkey as varchar),
       cast(l_linenumber as bigint), null, l_partkey, concat('P', l_partkey), cast(l_linenumber as bigint), null
from lineitem where l_linestatus = 'O'
""")
def flatten_players(spark, sf_dir):
    """A nested box score per line, as JSON text and back, flattened to its players."""
    documents = dealt(table(spark, sf_dir, "lineitem")).selectExpr(
        "to_date(l_shipdate) as game_date",
        "cast(l_orderkey as string) as game_id",
        """to_json(struct(struct(
             struct(cast(l_suppkey as string) as teamId, concat('S', l_suppkey) as teamTricode,
               array(
                 struct(cast(l_partkey as string) as personId, '' as displayName,
                        l_returnflag as firstName, l_linestatus as familyName,
                        struct(cast(l_quantity as bigint) as points, l_discount as plusMinusPoints) as statistics),
                 struct(concat('x', l_partkey) as personId, concat('Part ', l_partkey) as displayName,
                        l_returnflag as firstName, l_linestatus as familyName,
                        struct(cast(null as bigint) as points, l_tax as plusMinusPoints) as statistics)
               ) as players) as homeTeam,
             struct(concat(l_partkey, '.0') as teamId, concat('P', l_partkey) as teamTricode,
               if(l_linestatus = 'O',
                 array(struct(cast(l_linenumber as string) as personId, '' as displayName,
                              l_returnflag as firstName, '' as familyName,
                              struct(cast(l_linenumber as bigint) as points, cast(null as double) as plusMinusPoints)
                                as statistics)), null) as players) as awayTeam
           ) as boxScoreTraditional)) as text""",
    )
    parsed = documents.select(
        "game_date", "game_id", F.from_json("text", struct_of("").add(ENVELOPE, SMALL_BOX[ENVELOPE].dataType)).alias("d")
    ).select("game_date", "game_id", f"d.{ENVELOPE}")
    return plain(payloads.player_rows(parsed, [ENVELOPE]))


@query("""
select o_orderkey,
       case when o_orderstatus = 'P' then o_orderpriority
            when o_totalprice > 250000 then concat(o_orderstatus, ' ', o_orderpriority) end as player_name
from orders
""")
def player_names(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        C.player_name(
            F.expr("case o_orderstatus when 'P' then o_orderpriority when 'F' then '' end"),
            F.col("o_orderstatus"),
            F.expr("case when o_totalprice > 250000 then o_orderpriority when o_totalprice > 100000 then '' end"),
        ).alias("player_name"),
    )


@query("""
select p_partkey, try_cast(p_name as bigint) as name_id, try_cast(replace(p_brand, 'Brand#', '') as bigint) as brand_id,
       cast(p_size as bigint) as size_id, cast(null as bigint) as half_id, p_retailprice as price
from part
""")
def numeric_coerce(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        C.to_id(F.col("p_name")).alias("name_id"),
        C.to_id(F.replace("p_brand", F.lit("Brand#"), F.lit(""))).alias("brand_id"),
        C.to_id(F.concat("p_size", F.lit(".0"))).alias("size_id"),
        C.to_id(F.concat("p_size", F.lit(".5"))).alias("half_id"),
        C.to_number(F.col("p_retailprice")).alias("price"),
    )


@query("""
select l_orderkey, l_partkey, l_suppkey, l_linenumber,
       case when l_quantity > 5 then l_suppkey end as referee_1_id,
       case when l_quantity > 15 then l_partkey end as referee_2_id,
       case when l_quantity > 30 then cast(l_linenumber as bigint) end as referee_3_id,
       case when l_quantity > 5 then l_returnflag end as referee_1_name,
       case when l_quantity > 15 then l_linestatus end as referee_2_name,
       case when l_quantity > 30 then 'line' end as referee_3_name
from lineitem
""")
def officials_by_position(spark, sf_dir):
    """The first three of a list that holds none to four officials, depending on the quantity."""
    lists = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        """slice(array(
             struct(l_suppkey as personId, l_returnflag as name),
             struct(l_partkey as personId, l_linestatus as name),
             struct(cast(l_linenumber as bigint) as personId, 'line' as name),
             struct(l_orderkey as personId, 'order' as name)), 1,
             int(l_quantity > 5) + int(l_quantity > 15) + int(l_quantity > 30) + int(l_quantity > 40)) as officials""",
    )
    slots = range(payloads.OFFICIAL_SLOTS)
    return lists.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        *[C.official(F.col("officials"), i, "personId").alias(f"referee_{i + 1}_id") for i in slots],
        *[C.official(F.col("officials"), i, "name").alias(f"referee_{i + 1}_name") for i in slots],
    )


MINUTES_CASES = """case l_linenumber when 1 then null when 2 then '' when 3 then concat(l_partkey, '')
    when 4 then concat('ab:', l_suppkey) when 5 then concat('-', l_suppkey, ':30')
    when 6 then concat(l_partkey, ':', l_suppkey, ':1')
    else concat(' ', l_partkey, ' : +', l_suppkey % 60) end"""


@query(f"""
with t as (select l_orderkey, l_partkey, l_suppkey, l_linenumber,
                  coalesce(nullif({MINUTES_CASES}, ''), '0:00') as minutes from lineitem)
select l_orderkey, l_partkey, l_suppkey, l_linenumber, minutes,
       case when regexp_full_match(minutes, '\\s*[+-]?[0-9]+\\s*:\\s*[+-]?[0-9]+\\s*')
            then cast(replace(trim(split_part(minutes, ':', 1)), '+', '') as bigint) * 60
               + cast(replace(trim(split_part(minutes, ':', 2)), '+', '') as bigint)
            else 0 end as minutes_seconds
from t
""")
def minutes_seconds(spark, sf_dir):
    """Well-formed, signed, blank-padded and malformed playing times."""
    timed = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        C.minutes_text(F.expr(MINUTES_CASES)).alias("minutes"),
    )
    return timed.withColumn("minutes_seconds", C.minutes_to_seconds(F.col("minutes")))


@query("""
select l_orderkey, l_partkey, l_suppkey, l_linenumber, cast(l_quantity - 1 as bigint) as seconds,
       l_quantity - 1 = 0 as dnp_flag, l_quantity - 1 > 0 as games_played_flag
from lineitem
""")
def participation_flags(spark, sf_dir):
    timed = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cast(l_quantity - 1 as bigint) as seconds"
    )
    return timed.withColumns(
        {"dnp_flag": C.did_not_play(F.col("seconds")), "games_played_flag": C.played(F.col("seconds"))}
    )


@query("""
select l_linenumber, l_partkey, concat(l_orderkey, '_', l_suppkey) as row_key,
       case when l_quantity > 25 then concat(l_orderkey, '_', l_suppkey) end as key_or_null
from lineitem
""")
def row_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    player = F.when(F.col("l_quantity") > 25, F.col("l_suppkey"))
    return lines.select(
        "l_linenumber", "l_partkey",
        C.row_key(F.col("l_orderkey"), F.col("l_suppkey")).alias("row_key"),
        C.row_key(F.col("l_orderkey"), player).alias("key_or_null"),
    )


STAMP = datetime(2026, 3, 14, 5, 20, 56, tzinfo=timezone.utc)


@query("""
select o_orderkey, cast(cast(o_orderdate as date) as varchar) as game_date,
       '20260314052056' as load_batch_id, cast(1773465656 as bigint) as ingested_at_epoch
from orders
""")
def lineage_stamp(spark, sf_dir):
    stamped = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("game_date"),
        F.lit(C.batch_id(STAMP)).alias("load_batch_id"),
        F.unix_seconds(F.lit(STAMP)).alias("ingested_at_epoch"),
    )
    return plain(stamped)


ORDER_SCHEMA = struct_of("""
o_orderkey bigint
o_custkey bigint
o_totalprice double
o_orderstatus string
o_shippriority bigint
""")


@query("""
select o_orderkey, o_custkey, o_totalprice, o_orderstatus, cast(null as bigint) as o_shippriority from orders
""")
def locked_orders(spark, sf_dir):
    """Columns outside the schema go, an absent one comes in as null, order and types are fixed."""
    return lock_schema(fill_missing(table(spark, sf_dir, "orders"), ORDER_SCHEMA), ORDER_SCHEMA)


@query("""
select cast(cast(l_shipdate as date) as varchar) as game_date, l_orderkey as game_id, l_suppkey as player_id,
       l_partkey as team_id, l_quantity as quantity_adv, l_tax as tax_adv
from lineitem
""")
def suffixed_columns(spark, sf_dir):
    """A secondary statistics table without its identity columns and with its suffix."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "to_date(l_shipdate) as GAME_DATE", "l_orderkey as GAME_ID", "l_suppkey as PLAYER_ID", "l_partkey as TEAM_ID",
        "l_returnflag as PLAYER_NAME", "l_linestatus as TEAM_TRICODE", "l_quantity as quantity", "l_tax as tax",
    )
    return plain(payloads.suffixed(rows, "_ADV"))


@query("""
select c_custkey as id, c_name as name, c_mktsegment, cast(null as double) as s_acctbal from customer
union all select s_suppkey, s_name, null, s_acctbal from supplier
""")
def stacked_frames(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey as id", "c_name as name", "c_mktsegment")
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey as id", "s_name as name", "s_acctbal")
    return stack(customers, suppliers)


@query("""
select distinct o_custkey as player_id from orders where o_orderstatus <> 'F'
""")
def season_ids(spark, sf_dir):
    """Distinct ids of a listing with repeats and unparseable entries."""
    listing = table(spark, sf_dir, "orders").selectExpr(
        "case o_orderstatus when 'F' then concat('id ', o_custkey) when 'O' then concat(o_custkey, '.0')"
        " else concat(' ', o_custkey) end as PERSON_ID"
    )
    return plain(season_player_ids(listing))


@query("""
with t as (select l_orderkey, l_linenumber, concat(l_orderkey, repeat('9', 3 * l_linenumber)) as m, l_partkey % 60 as s from lineitem)
select l_orderkey, l_linenumber, concat(m, ':', s) as minutes,
       coalesce(try_cast(try_cast(m as hugeint) * 60 + s as bigint), 0) as seconds from t
""")
def extreme_minutes(spark, sf_dir):
    """Playing times up to far beyond 64 bits; such a value counts as no time and ends nothing."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        "concat(l_orderkey, repeat('9', cast(3 * l_linenumber as int)), ':', l_partkey % 60) as minutes",
    )
    return lines.withColumn("seconds", C.minutes_to_seconds(F.col("minutes")))
