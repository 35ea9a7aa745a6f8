import math
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from courtside import schema as S
from courtside.functions import calendar
from courtside.functions import columns as C
from courtside.operators import gates
from courtside.operators.shape import fill_missing, lock_schema


def one(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_minutes_to_seconds(spark):
    values = ["10:00", "00:30", "32:15", None, "", "5", "1:2:3", "ab:10", "-1:30", " 3 : +4 ", ":", "1:", "99999999999999999999:1"]
    assert one(spark, values, "string", C.minutes_to_seconds) == [600, 30, 1935, 0, 0, 0, 0, 0, -30, 184, 0, 0, 0]


def test_minutes_text(spark):
    assert one(spark, [None, "", "1:00", " "], "string", C.minutes_text) == ["0:00", "0:00", "1:00", " "]


def test_to_id(spark):
    values = ["12", "12.0", " 7 ", "12.5", "1e3", "1d", "NaN", "Infinity", "x", "", None, "9007199254740993", "-4"]
    expected = [12, 12, 7, None, 1000, None, None, None, None, None, None, 9007199254740993, -4]
    assert one(spark, values, "string", C.to_id) == expected


def test_player_name(spark):
    rows = spark.createDataFrame(
        [(1, "D", "F", "L"), (2, "", "F", "L"), (3, None, "F", "L"), (4, None, "F", ""), (5, None, None, "L"), (6, " ", "F", "L")],
        "i int, d string, f string, l string",
    ).select("i", C.player_name(F.col("d"), F.col("f"), F.col("l")).alias("n"))
    assert [r["n"] for r in rows.orderBy("i").collect()] == ["D", "F L", "F L", None, None, " "]


def test_margin_and_flags(spark):
    rows = spark.createDataFrame(
        [(1, 10, 7, True), (2, 10, 7, False), (3, 5, 5, True), (4, None, 5, False)], "i int, h bigint, a bigint, home boolean"
    )
    home, away, is_home = F.col("h"), F.col("a"), F.col("home")
    won = C.home_win(home, away)
    shown = rows.select("i", C.signed_margin(is_home, home, away), C.game_total(home, away), won, C.own_team_win(is_home, won))
    assert [tuple(r)[1:] for r in shown.orderBy("i").collect()] == [
        (3, 17, True, True), (-3, 17, True, False), (0, 10, False, False), (None, None, False, True)
    ]


def test_officials_by_position(spark):
    rows = spark.sql("select array(named_struct('personId', 5L, 'name', 'A')) as o")
    got = rows.select(C.official(F.col("o"), 0, "name"), C.official(F.col("o"), 2, "personId")).first()
    assert tuple(got) == ("A", None)


def test_row_key_needs_both_parts(spark):
    rows = spark.createDataFrame([("1", 2), ("1", None), (None, 2)], "g string, p bigint")
    assert [r[0] for r in rows.select(C.row_key(F.col("g"), F.col("p"))).collect()] == ["1_2", None, None]


def test_batch_id():
    assert C.batch_id(datetime(2026, 3, 14, 5, 20, 56)) == "20260314052056"


def test_run_days(spark):
    first, last, skipped = calendar.parse_range("02/12/2026", "02/19/2026", ["02/13/2026", "02/18/2026"])
    days = calendar.run_days(spark, first, last, skipped)
    assert [r[0].day for r in days.orderBy("GAME_DATE").collect()] == [12, 14, 15, 16, 17, 19]
    calendar.check_day_cap(first, last, skipped, 6)
    with pytest.raises(ValueError):
        calendar.check_day_cap(first, last, skipped, 5)


@pytest.mark.parametrize("start, end, excluded", [("2026-01-01", "01/02/2026", []), ("01/02/2026", "01/01/2026", []), ("01/01/2026", "01/02/2026", ["1-2-26"])])
def test_bad_ranges(start, end, excluded):
    with pytest.raises(ValueError):
        calendar.parse_range(start, end, excluded)


def test_number_batches(spark):
    days = calendar.run_days(spark, date(2026, 1, 1), date(2026, 1, 15))
    numbers = [r[1] for r in calendar.number_batches(days).orderBy("GAME_DATE").collect()]
    assert numbers == [0] * 7 + [1] * 7 + [2]


def test_schedule_yesterday_ignores_the_session_zone(spark):
    rows = spark.sql("select timestamp_ntz'2024-07-01 03:59:59' as t union all select timestamp_ntz'2024-07-01 04:00:00'")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = sorted(r[0] for r in rows.select(calendar.schedule_yesterday(F.col("t"))).collect())
            assert got == [date(2024, 6, 29), date(2024, 6, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_schema_has_its_columns():
    names = S.PLAYER_GAME.names
    assert len(names) == len(set(names)) == 105
    kinds = [f.dataType.simpleString() for f in S.PLAYER_GAME.fields]
    counts = {kind: kinds.count(kind) for kind in set(kinds)}
    assert counts == {"bigint": 27, "double": 52, "string": 19, "boolean": 5, "date": 1, "timestamp": 1}
    assert [names[i - 1] for i in (1, 8, 30, 48, 71, 89, 97, 105)] == [
        "PLAYER_ID", "GAME_DATE", "GAMES_PLAYED_FLAG", "points", "PIE_ADV", "percentagePoints_USAGE",
        "oppOffensiveReboundPercentage_TEAM", "LOAD_BATCH_ID",
    ]


def test_lock_schema(spark):
    schema = S.struct_of("a bigint\nb string")
    df = spark.createDataFrame([("x", 1.0, 7)], "extra string, c double, a int")
    with pytest.raises(ValueError, match="b"):
        lock_schema(df, schema)
    locked = lock_schema(fill_missing(df, schema), schema)
    assert locked.schema == schema and tuple(locked.first()) == (7, None)
    whole = lock_schema(fill_missing(spark.range(1)))
    assert whole.schema == S.PLAYER_GAME


def test_column_checks():
    gates.check_columns(["ROW_KEY", "PLAYER_ID", "minutes_SECONDS"])
    with pytest.raises(ValueError, match="missing"):
        gates.check_columns(["ROW_KEY"])
    with pytest.raises(ValueError, match="duplicate"):
        gates.check_columns(["ROW_KEY", "PLAYER_ID", "minutes_SECONDS", "PLAYER_ID"])


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (math.nan, None), (None, "c")], "x double, s string")
    assert {tuple(r) for r in gates.null_profile(df).collect()} == {("x", 2), ("s", 1)}


def test_gate_report_for_empty_days(spark):
    rows = spark.createDataFrame(
        [(date(2026, 1, 1), "a", 1, 5), (date(2026, 1, 1), "a", None, -5)],
        "GAME_DATE date, ROW_KEY string, PLAYER_ID bigint, minutes_SECONDS bigint",
    )
    days = calendar.run_days(spark, date(2026, 1, 1), date(2026, 1, 2))
    report = gates.gate_report(gates.day_counts(rows), days).where("not pass")
    assert {(r["GAME_DATE"].day, r["gate"], r["bad_rows"]) for r in report.collect()} == {
        (1, "duplicate_row_key", 1), (1, "null_player_id", 1), (1, "negative_minutes", 1), (1, "null_values", 1),
        (2, "empty", 1),
    }


def test_stamp_is_utc(spark):
    moment = datetime(2026, 3, 14, 5, 20, 56, tzinfo=timezone.utc)
    assert spark.range(1).select(F.lit(moment).cast("string")).first()[0] == "2026-03-14 05:20:56"


def test_ids_that_a_cast_refuses_are_kept_from_it(spark):
    """A refused cast is an exception thrown and caught, for each value."""
    ids = ["7", " -7\t", "+7\x00", "7.0", "7.5", "7e1", "x7", "", None, "9007199254740993", "9223372036854775807"]
    assert one(spark, ids, "string", C.to_id) == [7, -7, 7, 7, None, 70, None, None, None, 9007199254740993, 9223372036854775807]
    frame = spark.createDataFrame([(value,) for value in ids], "v string").select(C.to_id(F.col("v")).alias("id"))
    plan = frame._jdf.queryExecution().analyzed().toString()
    assert plan.index("RLIKE") < plan.index("try_cast")
    casts = spark.createDataFrame([(value,) for value in ids], "v string").select("v", (~F.col("v").rlike(C._NO_WHOLE_NUMBER)).alias("cast"))
    assert {r["v"] for r in casts.where("cast").collect()} == {"7", " -7\t", "+7\x00", "", "9007199254740993", "9223372036854775807"}
