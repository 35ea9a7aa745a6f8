from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from courtside import schema as S
from courtside.operators import audits, gates
from courtside.plans import day_load, monitoring
from courtside.plans.day_load import load_days
from courtside.sources import store as stores
from courtside.sources.landing import Landing
from courtside.sources.published import PublishedTable, expected_counts
from courtside.sources.store import Store
from fixtures import DAY1, DAY2, DAY4, Landed, player

NOW = datetime(2026, 1, 9, 6, 7, 8, tzinfo=timezone.utc)
LATER = datetime(2026, 1, 10, 6, 7, 8, tzinfo=timezone.utc)
ROWS = S.struct_of("id bigint\nversion int\nGAME_DATE date")


def rows(spark, version, *days):
    data = [(k, version, date.fromisoformat(day)) for day in days for k in range(4)]
    return spark.createDataFrame(data, ROWS)


def served(table):
    return {(str(r[0]), r[1]): r[2] for r in table.rows().groupBy("GAME_DATE", "version").count().collect()}


@pytest.fixture
def table(spark, tmp_path):
    made = PublishedTable(spark, f"published_{tmp_path.name.replace('-', '_')}", str(tmp_path), ROWS)
    made.create()
    made.create()
    yield made
    spark.sql(f"DROP TABLE {made.table}")


def test_dates_that_fail_their_audit_serve_their_old_rows(spark, table):
    first = rows(spark, 1, DAY1, DAY2)
    assert all(r["pass"] for r in table.publish(first, expected_counts(first), "1").collect())
    second = rows(spark, 2, DAY1, DAY2, DAY4)
    lost = second.where(f"GAME_DATE <> date'{DAY2}' or id > 0")
    report = {str(r["GAME_DATE"]): (r["expected_rows"], r["stored_rows"], r["pass"]) for r in table.publish(lost, expected_counts(second), "2").collect()}
    assert report == {DAY1: (4, 4, True), DAY2: (4, 3, False), DAY4: (4, 4, True)}
    assert served(table) == {(DAY1, 2): 4, (DAY2, 1): 4, (DAY4, 2): 4}


def test_a_reader_sees_nothing_of_a_version_that_is_not_swapped(spark, table):
    one = rows(spark, 1, DAY1)
    table.publish(one, expected_counts(one), "1")
    folder = table.stage(rows(spark, 2, DAY1, DAY2), "2")
    assert served(table) == {(DAY1, 1): 4}
    table.swap(folder, [date.fromisoformat(DAY2)])
    assert served(table) == {(DAY1, 1): 4, (DAY2, 2): 4}


def test_retired_versions_are_those_that_no_date_points_at(spark, table):
    for version in (1, 2, 3):
        new = rows(spark, version, *([DAY1, DAY2] if version < 3 else [DAY1]))
        table.publish(new, expected_counts(new), str(version))
    before = served(table)
    assert table.retire() == 3 and table.retire() == 0
    assert served(table) == before == {(DAY1, 3): 4, (DAY2, 2): 4}


def test_publishing_reads_only_the_asked_dates(spark, table):
    new = rows(spark, 1, DAY1, DAY2)
    table.publish(new, expected_counts(new), "1")
    plan = table.rows().where(f"GAME_DATE = date'{DAY1}'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(GAME_DATE" in plan and "InMemoryFileIndex(1 paths)" in plan


def test_roots_with_odd_characters(spark, tmp_path):
    made = PublishedTable(spark, "published_odd", str(tmp_path / "it's a root"), ROWS)
    made.create()
    for version in (1, 2):
        new = rows(spark, version, DAY1)
        made.publish(new, expected_counts(new), str(version))
    assert made.retire() == 1 and served(made) == {(DAY1, 2): 4}
    spark.sql("DROP TABLE published_odd")


def test_no_rows_publish_nothing(spark, table):
    none = rows(spark, 1)
    assert table.publish(none, expected_counts(none), "1").collect() == [] and served(table) == {}


def landed_days(**first):
    landed = Landed()
    for day, game in ((DAY1, "1"), (DAY2, "2")):
        landed.scoreboard(day, game)
        landed.game(day, game, [player(1), player(2)], [player(3)], **(first if day == DAY1 else {}))
    landed.info(1, 2, 3)
    return landed


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path / "store"), f"log_{tmp_path.name.replace('-', '_')}")
    yield made
    for name in (made.log_table, f"{made.log_table}_state"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def status(result):
    return {str(r["GAME_DATE"]): (r["STATUS"], r["ROWS"]) for r in result.ledger.collect()}


def test_a_load_that_loses_rows_leaves_the_old_ones(spark, store, tmp_path, monkeypatch):
    landing = Landing(spark, landed_days().write(tmp_path / "l"))
    assert status(load_days(landing, store, "01/05/2026", "01/06/2026", NOW)) == {DAY1: ("loaded", 3), DAY2: ("loaded", 3)}
    whole = stores.spread_days
    monkeypatch.setattr(
        stores, "spread_days", lambda df, counts, **more: whole(df, counts, **more).where(f"GAME_DATE <> date'{DAY1}' or PLAYER_ID > 1")
    )
    assert status(load_days(landing, store, "01/05/2026", "01/06/2026", LATER)) == {DAY1: ("failed", 0), DAY2: ("loaded", 3)}
    batches = {(str(r[0]), r[1]): r[2] for r in store.log().groupBy("GAME_DATE", "LOAD_BATCH_ID").count().collect()}
    assert batches == {(DAY1, "20260109060708"): 3, (DAY2, "20260110060708"): 3}
    assert {str(r[0]): r[1] for r in audits.daily_status_of(store.state()).collect()} == {DAY1: 3, DAY2: 3}


def test_state_equals_a_scan(spark, store, tmp_path):
    landed = landed_days()
    landed.scoreboard(DAY4, "4", "5")
    landed.game(DAY4, "4", [player(k) for k in range(1, 7)], [player(k) for k in range(7, 12)])
    landed.game(DAY4, "5", [player(1)], [])
    landed.info(*range(4, 12))
    load_days(Landing(spark, landed.write(tmp_path / "l")), store, "01/05/2026", "01/08/2026", NOW)
    log, state, span = store.log(), store.state(), (date(2026, 1, 4), date(2026, 1, 9))
    scan, kept = monitoring.data_health(log, *span), monitoring.data_health_of(state, *span)
    integrity = monitoring.game_integrity(log, *span)
    counts = monitoring.game_counts_of(state, *span)
    for wanted, found in zip(
        (scan.status, scan.missing, scan.duplicates, integrity.team_counts, integrity.low_team_players, integrity.low_game_players),
        (kept.status, kept.missing, kept.duplicates, *counts),
        strict=True,
    ):
        assert wanted.columns == found.columns and sorted(map(tuple, wanted.collect())) == sorted(map(tuple, found.collect()))
    assert [tuple(r) for r in counts[0].collect()] == [("5", 1)] and counts[2].count() == 3
    # the same through a store without a catalog
    plain = Store(spark, str(tmp_path / "plain"))
    load_days(Landing(spark, str(tmp_path / "l")), plain, "01/05/2026", "01/08/2026", NOW)
    assert sorted(map(str, plain.state().collect())) == sorted(map(str, state.collect()))


def test_observed_gates_equal_scanned_ones(spark, tmp_path, monkeypatch):
    landed = landed_days(officials=2)
    for day, game, home in (
        ("2026-01-07", "3", [player(1, minutes="-1:30"), player(2)]),
        (DAY4, "4", [player("oops")]),
    ):
        landed.scoreboard(day, game)
        landed.game(day, game, home, [player(3)])
    landed.scoreboard("2026-01-09", "5")
    landed.game("2026-01-09", "5", [player(1)], [player(1)])  # the same row key on both sides
    landing = Landing(spark, landed.write(tmp_path / "l"))
    reports, days = [], ("01/05/2026", "01/09/2026")
    with monkeypatch.context() as patch:
        patch.setattr(gates, "day_counts", lambda *a, **k: pytest.fail("the rows are read again"))
        reports.append(load_days(landing, Store(spark, str(tmp_path / "a")), *days, NOW).gates)
    monkeypatch.setattr(day_load, "OBSERVED_DAYS", 0)
    reports.append(load_days(landing, Store(spark, str(tmp_path / "b")), *days, NOW).gates)
    seen, scanned = (sorted(map(tuple, r.collect())) for r in reports)
    assert seen == scanned
    assert {(str(r[0]), r[1]) for r in seen if not r[3]} == {
        (DAY1, "null_values"), ("2026-01-07", "negative_minutes"), (DAY4, "null_player_id"), (DAY4, "null_values"),
        ("2026-01-09", "duplicate_row_key"),
    }


def test_observed_days_are_batched(spark):
    days = [date(2026, 1, 1 + k) for k in range(9)]
    df = spark.createDataFrame([(d, "k", 1, 5) for d in days[:5]], "GAME_DATE date, ROW_KEY string, PLAYER_ID int, minutes_SECONDS int")
    observed = gates.ObservedDays(days, per=4)
    assert len(observed.batches) == 3
    observed.watch(df, F.lit(2)).write.format("noop").mode("overwrite").save()
    counts = observed.counts(spark, df)
    assert sorted(map(tuple, counts.select("GAME_DATE", "rows", "null_values").collect())) == [(d, 1, 2) for d in days[:5]]


def test_ledger_snapshots(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    entries = [("01", DAY1, "failed"), ("01", DAY2, "loaded"), ("02", DAY1, "loaded"), ("03", DAY4, "failed")]

    def append(run):
        data = [(date.fromisoformat(day), state, 1, run, 0) for r, day, state in entries if r == run]
        store.append_ledger(spark.createDataFrame(data, S.LEDGER))

    def current():
        return {(str(r["GAME_DATE"]), r["STATUS"], r["LOAD_BATCH_ID"]) for r in store.current_ledger().collect()}

    append("01")
    assert current() == {(DAY1, "failed", "01"), (DAY2, "loaded", "01")}
    store.compact_ledger()
    append("02")
    assert current() == {(DAY1, "loaded", "02"), (DAY2, "loaded", "01")}
    store.compact_ledger()
    append("03")
    wanted = {(DAY1, "loaded", "02"), (DAY2, "loaded", "01"), (DAY4, "failed", "03")}
    assert current() == wanted and store.ledger().count() == 4
    plan = store.current_ledger()._jdf.queryExecution().executedPlan().toString()
    assert any("LOAD_BATCH_ID" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])
    # a snapshot that was cut off is not read
    (Path(store.snapshot_path) / "99").mkdir()
    assert current() == wanted
    store.compact_ledger()
    assert current() == wanted


def test_an_empty_ledger_is_not_compacted(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.append_ledger(spark.createDataFrame([], S.LEDGER))
    store.compact_ledger()
    assert not Path(store.snapshot_path).exists()


def test_column_report_and_check_agree(spark):
    df = spark.range(1).selectExpr("id as ROW_KEY", "id as a", "id as a", "id as GAME_DATE")
    found = {tuple(r) for r in gates.column_report(df, ["ROW_KEY", "b"]).collect()}
    assert found == {("b", "missing", 0), ("a", "duplicate", 2)}
    with pytest.raises(ValueError):
        gates.check_columns(df.columns, ["ROW_KEY"])


def test_footer_counts_equal_a_scan(spark, tmp_path):
    plain = Store(spark, str(tmp_path / "plain"))
    load_days(Landing(spark, landed_days().write(tmp_path / "l")), plain, "01/05/2026", "01/06/2026", NOW)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    found = stores.footer_counts(spark, plain.log_path, S.PLAYER_GAME, ["PLAYER_ID", "points", "POSITION"])
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert sorted(map(tuple, found.collect())) == [(date.fromisoformat(d), 3, 0, 0, 0) for d in (DAY1, DAY2)]
    holes = spark.createDataFrame([(1, None, date(2026, 1, 5)), (None, "x", date(2026, 1, 5)), (None, "y", date(2026, 1, 6))], "a int, b string, GAME_DATE date")
    holes.write.partitionBy("GAME_DATE").parquet(str(tmp_path / "holes"))
    found = stores.footer_counts(spark, str(tmp_path / "holes"), holes.schema, ["a", "b"])
    assert sorted(map(tuple, found.collect())) == [(date(2026, 1, 5), 2, 1, 1), (date(2026, 1, 6), 1, 1, 0)]
