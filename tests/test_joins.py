import glob
from datetime import date

import pytest
from pyspark.sql import functions as F

from courtside.operators import joins, outcome
from courtside.sources import store as stores


def skewed(spark, rows=3000):
    """A third of the rows on key 0, another third without a key, the rest spread thinly."""
    return spark.range(rows).select(
        F.col("id").alias("n"),
        F.expr("case id % 3 when 0 then 0 when 1 then null else id end").alias("k"),
        (F.col("id") % 7).alias("v"),
    )


def as_set(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
}


@pytest.fixture
def split_small(spark):
    before = {key: spark.conf.get(key, None) for key in SPLIT}
    for key, value in SPLIT.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_one_scan_a_side_and_hot_keys_are_split(split_small, tmp_path):
    spark = split_small
    skewed(spark, 60_000).repartition(8).write.parquet(f"{tmp_path}/l")
    spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w")).write.parquet(f"{tmp_path}/r")
    left, right = spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/r")
    joined = joins.join_to_one(left, right, ["k"])
    rows = joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2 and "skew=true" in plan
    assert len(rows) == 60_000
    assert all(r["w"] == (r["k"] * 10 if r["k"] is not None and r["k"] < 3000 and r["k"] % 2 == 0 else None) for r in rows)


def test_outcome_with_a_hot_game(spark):
    rows = skewed(spark).select(
        F.col("k").alias("game"), "n", (F.col("n") % 2).alias("team"), (F.col("n") % 2 == 0).alias("home"), F.col("v").alias("pts")
    )
    found = {r["n"]: r for r in outcome.with_outcome(rows, ["game"], "team", "pts", "home").collect()}
    scores = {True: sum(n % 7 for n in range(0, 3000, 3) if n % 2 == 0), False: sum(n % 7 for n in range(0, 3000, 3) if n % 2)}
    won = scores[True] > scores[False]
    assert len(found) == 3000
    assert all(found[n]["HOME_TEAM_WIN_FLAG"] == won for n in range(0, 3000, 3))
    assert not any(found[n]["HOME_TEAM_WIN_FLAG"] for n in range(1, 3000, 3))


def test_guards(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (3, "y")], "k int, r string")
    assert joins.guarded_join(left, right, ["k"]).count() == 3
    with pytest.raises(joins.CardinalityError, match="left"):
        joins.guarded_join(left, right, ["k"], "1:1")
    with pytest.raises(joins.CardinalityError, match="right"):
        joins.guarded_join(right, left, ["k"])
    with pytest.raises(ValueError, match="unknown"):
        joins.guarded_join(left, right, ["k"], "m:n")


def test_missing_from_ignores_nulls(spark):
    left = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    assert [r[0] for r in joins.missing_from(left, left.where("k = 2"), ["k"]).collect()] == [1]


def test_team_points_of_nulls(spark):
    rows = spark.createDataFrame(
        [(1, "a", None), (1, "b", 3), (1, None, 9), (None, "a", 9)], "g int, t string, p bigint"
    )
    assert sorted(map(tuple, outcome.team_points(rows, ["g"], "t", "p").collect())) == [(1, "a", 0), (1, "b", 3)]


def test_a_large_date_is_split_over_files(spark, tmp_path):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 2000, F.lit(date(2026, 1, 1))).otherwise(F.lit(date(2026, 1, 2))).alias("GAME_DATE"),
        F.col("id").cast("string").alias("ROW_KEY"), F.lit(1).alias("PLAYER_ID"), F.lit(1).alias("PLAYER_TEAM_ID"),
    )
    counts = rows.groupBy("GAME_DATE").agg(F.count(F.lit(1)).alias("rows"))
    path = str(tmp_path / "t")
    stores.replace_days(stores.spread_days(rows, counts, rows_per_file=250), path)
    assert len(glob.glob(f"{path}/GAME_DATE=2026-01-01/*.parquet")) > 2
    stores.replace_days(stores.spread_days(rows, counts.where("rows = 1000")), path)
    assert len(glob.glob(f"{path}/GAME_DATE=2026-01-02/*.parquet")) == 1
    assert spark.read.parquet(path).count() == 3000
