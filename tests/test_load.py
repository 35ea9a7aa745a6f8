import json
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from courtside import schema as S
from courtside.operators import payloads
from courtside.plans import assemble as A
from courtside.plans import day_load
from courtside.plans.day_load import load_days, load_yesterday, schedule_yesterday
from courtside.plans.dimensions import build_arena_dimension, build_player_dimension
from courtside.plans.monitoring import command_center, data_health, game_integrity
from courtside.operators.audits import current_status, run_summary
from courtside.session import _SHUFFLES_GO, shuffles_dropped
from courtside.sources.landing import Landing, player_attributes
from courtside.sources.store import Store
from fixtures import AWAY, DAY1, DAY2, DAY3, DAY4, HOME, Landed, other, player

NOW = datetime(2026, 1, 9, 6, 7, 8, tzinfo=timezone.utc)


def landed_days():
    landed = Landed()
    landed.scoreboard(DAY1, "0022500001", "0022500002")
    landed.game(DAY1, "0022500001", [player(1, 60), player(2, 40)], [player(3, 50), player(4, 41, "0:00")])
    landed.game(DAY1, "0022500002", [player(5, 45)], [player(6, 45)], home_score=7, away_score=9)  # a tie by points
    landed.scoreboard(DAY2, "0022500003")
    landed.game(DAY2, "0022500003", [player(1), player(2)], [player(3)], officials=2)  # null official
    landed.scoreboard(DAY3)  # a day without games
    landed.scoreboard(DAY4, "0022500004")
    landed.game(DAY4, "0022500004", [player(1)], [player(7, minutes=None)])
    landed.game(DAY4, "0022500099", [player(1)], [player(3)])  # not on the scoreboard
    landed.season(1, 2, "x", 2, 50)
    landed.info(1, 2, 3, 4, 5, 6, 7)
    return landed


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("load")
    landing = Landing(spark, landed_days().write(root / "landing"))
    store = Store(spark, str(root / "store"))
    build = build_player_dimension(store, landing.season_players(), landing.player_info(), NOW)
    result = load_days(landing, store, "01/05/2026", "01/08/2026", NOW)
    return landing, store, build, result


def test_player_dimension_build(loaded):
    _, _, build, _ = loaded
    coverage = build.coverage.first()
    # taken lazily, so it also sees the players that the load added
    assert coverage["season_players"] == 3
    assert coverage["missing_players"] == 1
    assert [r[0] for r in build.still_missing.collect()] == [50]


def test_good_dates_load_and_bad_dates_do_not(loaded):
    _, store, _, result = loaded
    ledger = {str(r["GAME_DATE"]): (r["STATUS"], r["ROWS"]) for r in result.ledger.collect()}
    assert ledger == {DAY1: ("loaded", 6), DAY2: ("failed", 0), DAY4: ("loaded", 2)}
    assert store.log().count() == 8
    bad = [(str(r["GAME_DATE"]), r["gate"], r["bad_rows"]) for r in result.gates.where("not pass").collect()]
    assert bad == [(DAY2, "null_values", 6)]
    summary = {r["STATUS"]: r["day_list"] for r in run_summary(store.ledger()).collect()}
    assert summary == {"loaded": [DAY1, DAY4], "failed": [DAY2]}


def test_stored_rows(loaded):
    _, store, _, _ = loaded
    log = store.log()
    assert log.schema.names == S.PLAYER_GAME.names
    rows = {r["ROW_KEY"]: r for r in log.collect()}
    first, third = rows["0022500001_1"], rows["0022500001_3"]
    assert first["HOME_FLAG"] and not third["HOME_FLAG"]
    assert (first["POINT_MARGIN"], third["POINT_MARGIN"]) == (10, -10)
    assert first["GAME_TOTAL_POINTS"] == 190
    assert first["HOME_TEAM_WIN_FLAG"] and first["PLAYER_TEAM_WIN_FLAG"]
    assert third["HOME_TEAM_WIN_FLAG"] and not third["PLAYER_TEAM_WIN_FLAG"]
    assert first["minutes_SECONDS"] == 600 and first["GAMES_PLAYED_FLAG"]
    assert rows["0022500001_4"]["DNP_FLAG"]
    # equal summed points: no home win, and the away side counts as the winner
    tie_home, tie_away = rows["0022500002_5"], rows["0022500002_6"]
    assert not tie_home["HOME_TEAM_WIN_FLAG"] and not tie_home["PLAYER_TEAM_WIN_FLAG"]
    assert tie_away["PLAYER_TEAM_WIN_FLAG"] and tie_away["POINT_MARGIN"] == 2
    assert rows["0022500004_7"]["minutes"] == "0:00" and rows["0022500004_7"]["DNP_FLAG"]
    assert first["ARENA_NAME"] == "TD Garden" and first["EXP"] == "1"
    assert first["LOAD_BATCH_ID"] == "20260109060708"
    assert first["REFEREE_3_NAME"] == "Ref 2" and first["PIE_ADV"] == 0.5
    assert first["offensiveReboundPercentage_TEAM"] == 0.25
    assert first["PLAYER_TEAM_ID"] == HOME and third["PLAYER_TEAM_ID"] == AWAY


def test_rerun_gives_the_same_rows(spark, loaded):
    landing, store, _, _ = loaded
    before = sorted(map(tuple, store.log().collect()))
    load_days(landing, store, "01/05/2026", "01/05/2026", NOW)
    assert sorted(map(tuple, store.log().collect())) == before
    assert store.players().count() == store.players().distinct().count() == 7


def test_steps_in_a_row_equal_assemble(loaded):
    landing, _, _, _ = loaded
    trad = payloads.player_rows(landing.traditional(), [S.TRADITIONAL_ENVELOPE])
    adv = payloads.player_rows(landing.advanced(), [S.ADVANCED_ENVELOPE])
    usage = payloads.player_rows(landing.usage(), [S.USAGE_ENVELOPE])
    four = payloads.team_factor_rows(landing.four_factors())
    live = payloads.live_game_rows(landing.live())
    chain = A.with_outcome(
        A.with_game_metadata(A.with_team_context(A.player_table(trad, adv, usage), four), live)
    )
    whole = A.assemble(trad, adv, usage, four, live)
    columns = sorted(chain.columns)
    assert sorted(whole.columns) == columns
    assert sorted(map(str, chain.select(columns).collect())) == sorted(map(str, whole.select(columns).collect()))
    missing = A.unmatched_players(chain, chain.where("PLAYER_ID < 5").select("PLAYER_ID").distinct())
    assert sorted(r[0] for r in missing.collect()) == [5, 6, 7]


def simple(day=DAY1, landed=None, home=None, away=None, listed=None, **kwargs):
    landed = landed or Landed()
    landed.scoreboard(day, *(listed or ["1"]))
    landed.game(day, "1", [player(1)] if home is None else home, [player(2)] if away is None else away, **kwargs)
    landed.info(1, 2)
    return landed


def test_each_gate_fails_only_its_date(spark, tmp_path):
    twice = [other(1, S.ADVANCED), other(8, S.ADVANCED), other(8, S.ADVANCED)]
    cases = {
        "repeated_key": [
            {"home": [player(1), player(1)]},
            {"advanced": (twice, [other(2, S.ADVANCED)])},  # the repeated player has no traditional row
            {"listed": ["1", "1"]},
        ],
        "null_player_id": [{"home": [player("oops")]}],
        "negative_minutes": [{"home": [player(1, minutes="-1:30")]}],
        "null_values": [{"home": [player(1, assists=None)]}, {"home": [player(99)]}],
        "missing_game": [{"home": [], "away": []}, {"listed": ["1", "2"]}],
        "none": [{}],
    }
    expected, landed = {}, Landed()
    for gate, changes in cases.items():
        for change in changes:
            day = f"2026-03-{len(expected) + 1:02d}"
            expected[day] = gate
            simple(day, landed, **change)
    broken = "2026-03-30"
    expected[broken] = "scoreboard_payload"
    landed.files["scoreboard"].append({"game_date": broken, "scoreboard": {}})

    landing = Landing(spark, landed.write(tmp_path / "landing"))
    store = Store(spark, str(tmp_path / "store"))
    result = load_days(landing, store, "03/01/2026", "03/31/2026", NOW, max_days=None)
    failed = {}
    for row in result.gates.where("not pass").collect():
        failed.setdefault(str(row["GAME_DATE"]), set()).add(row["gate"])
    for day, gate in expected.items():
        assert (gate in failed.get(day, set())) if gate != "none" else day not in failed, (day, gate, failed)
    status = {str(r["GAME_DATE"]): r["STATUS"] for r in result.ledger.collect()}
    assert status == {day: "loaded" if gate == "none" else "failed" for day, gate in expected.items()}
    assert store.log().count() == 2
    batches = {str(r["GAME_DATE"]): r["BATCH_NO"] for r in result.ledger.collect()}
    assert batches["2026-03-01"] == 0 and batches["2026-03-08"] == 1 and batches[broken] == 4

    bad = landing.scoreboard().where("scoreboard.games is null")
    with pytest.raises(Exception, match="no games"):
        payloads.scoreboard_games(bad).collect()


def test_broken_lines(spark, tmp_path):
    root = simple().write(tmp_path / "landing")
    with open(f"{root}/live/part.json", "w") as out:
        out.write('{"game_date": "2026-01-05", "game_id"\n')
    store = Store(spark, str(tmp_path / "store"))
    result = load_days(Landing(spark, root), store, "01/05/2026", "01/05/2026", NOW)
    assert {r["gate"] for r in result.gates.where("not pass").collect()} == {"rejected_line"}
    with open(f"{root}/scoreboard/part.json", "a") as out:
        out.write("{broken\n")
    with pytest.raises(ValueError, match="1 scoreboard lines are malformed"):
        load_days(Landing(spark, root), store, "01/05/2026", "01/05/2026", NOW)


def test_a_line_without_a_date_stops_the_run(spark, tmp_path):
    landed = simple()
    landed.files["scoreboard"].append({"scoreboard": {"games": [{"gameId": "77"}]}})
    root = landed.write(tmp_path / "landing")
    with pytest.raises(ValueError, match="without a date"):
        load_days(Landing(spark, root), Store(spark, str(tmp_path / "store")), "01/05/2026", "01/05/2026", NOW)


def test_a_broken_line_of_a_known_date_fails_that_date_alone(spark, tmp_path):
    root = tmp_path / "landing"
    landed = simple()
    simple("2026-01-06", landed)
    landed.write(root)
    lines = (root / "scoreboard" / "part.json").read_text().splitlines()
    (root / "scoreboard" / "part.json").unlink()
    for line, tail in zip(lines, ("", "{broken\n"), strict=True):
        day = json.loads(line)["game_date"]
        (root / "scoreboard" / f"game_date={day}").mkdir()
        (root / "scoreboard" / f"game_date={day}" / "part.json").write_text(line + "\n" + tail)
    result = load_days(Landing(spark, str(root)), Store(spark, str(tmp_path / "store")), "01/05/2026", "01/06/2026", NOW)
    assert {str(r["GAME_DATE"]): r["STATUS"] for r in result.ledger.collect()} == {DAY1: "loaded", DAY2: "failed"}
    bad = result.gates.where("not pass").collect()
    assert [(r["gate"], r["bad_rows"]) for r in bad] == [("scoreboard_payload", 1)]


def test_an_unidentified_game_fails_its_date(spark, tmp_path):
    landed = simple()
    simple("2026-01-06", landed, listed=["1", None])
    result = load_days(Landing(spark, landed.write(tmp_path / "l")), Store(spark, str(tmp_path / "s")), "01/05/2026", "01/06/2026", NOW)
    assert {str(r["GAME_DATE"]): r["STATUS"] for r in result.ledger.collect()} == {DAY1: "loaded", DAY2: "failed"}
    assert [r["gate"] for r in result.gates.where("not pass").collect()] == ["unidentified_game"]


def test_an_overflow_ends_no_other_date(spark, tmp_path):
    landed = simple()
    simple("2026-01-06", landed, home=[player(1, minutes="999999999999999999:00")])
    store = Store(spark, str(tmp_path / "s"))
    load_days(Landing(spark, landed.write(tmp_path / "l")), store, "01/05/2026", "01/06/2026", NOW)
    seconds = {(str(r["GAME_DATE"]), r["PLAYER_ID"]): r["minutes_SECONDS"] for r in store.log().collect()}
    assert seconds == {(DAY1, 1): 600, (DAY1, 2): 600, (DAY2, 1): 0, (DAY2, 2): 600}


def test_unlisted_games_count_nowhere(spark, tmp_path):
    landed = simple()
    for _ in range(2):
        landed.game("2026-01-05", "99", [player(1)], [player(2)])
    store = Store(spark, str(tmp_path / "s"))
    result = load_days(Landing(spark, landed.write(tmp_path / "l")), store, "01/05/2026", "01/05/2026", NOW)
    assert result.gates.where("not pass").count() == 0 and store.log().count() == 2


def test_the_report_says_why(spark, tmp_path):
    landed = simple(home=[player(1, assists=None)])
    simple("2026-01-06", landed, home=[player(1), player(1)], listed=["1", "2"])
    result = load_days(Landing(spark, landed.write(tmp_path / "l")), Store(spark, str(tmp_path / "s")), "01/05/2026", "01/06/2026", NOW)
    assert [(str(r[0]), r[1], r[2]) for r in result.null_columns.collect()] == [(DAY1, "assists", 1)]
    repeated = {(str(r[0]), r[1], r[2], r[3]) for r in result.repeated_keys.collect()}
    assert repeated == {(DAY2, name, f"1, 1, {HOME}", 2) for name in ("traditional", "advanced", "usage")}
    assert [(str(r[0]), r[1]) for r in result.missing_games.collect()] == [(DAY2, "2")]


def test_staged_rows_go_after_the_load(spark, tmp_path):
    landing = Landing(spark, simple().write(tmp_path / "l"))
    store = Store(spark, str(tmp_path / "s"))
    gone = load_days(landing, store, "01/05/2026", "01/05/2026", NOW)
    kept = load_days(landing, store, "01/05/2026", "01/05/2026", NOW, keep_staged=True)
    assert not Path(f"{gone.folder}/data").exists() and gone.gates.count() and gone.ledger.count() == 1
    assert Path(f"{kept.folder}/data/rows").exists()


def test_attributes_prefer_complete_rows(spark):
    info = spark.createDataFrame([(1, None, "6-1", "3"), (1, "G", "6-2", "4"), (2, None, None, None)], "PLAYER_ID long, POSITION string, HEIGHT string, SEASON_EXP string")
    found = {tuple(r) for r in player_attributes(info, info).collect()}
    assert found == {(1, "G", "6-2", "4"), (2, None, None, None)}


def test_wide_rows_move_once_before_the_write(spark, tmp_path):
    landed = simple()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        landing = Landing(spark, landed.write(tmp_path / "l"))
        rows = A.assemble(
            payloads.player_rows(landing.traditional(), [S.TRADITIONAL_ENVELOPE]), payloads.player_rows(landing.advanced(), [S.ADVANCED_ENVELOPE]),
            payloads.player_rows(landing.usage(), [S.USAGE_ENVELOPE]), payloads.team_factor_rows(landing.four_factors()), payloads.live_game_rows(landing.live()),
        )
        plan = rows._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    widths = []

    def walk(node):
        if "Exchange" in node.nodeName():
            widths.append(node.output().size())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(plan.initialPlan() if "Adaptive" in plan.nodeName() else plan)
    # The box scores have up to 27 columns, the joined rows 68 and more.
    assert len(widths) >= 4 and max(widths) <= 40, widths


def test_a_large_dimension_is_joined_by_shuffle(spark, loaded):
    landing, store, _, _ = loaded
    before = sorted(map(tuple, store.log().collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        load_days(landing, store, "01/05/2026", "01/08/2026", NOW)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, store.log().collect())) == before


def test_failed_date_keeps_its_partition(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    load_days(Landing(spark, simple().write(tmp_path / "a")), store, "01/05/2026", "01/05/2026", NOW)
    worse = simple(home=[player(1, assists=None)])
    later = NOW + timedelta(seconds=1)
    load_days(Landing(spark, worse.write(tmp_path / "b")), store, "01/05/2026", "01/05/2026", later)
    assert store.log().count() == 2
    by_run = {(r["LOAD_BATCH_ID"], r["STATUS"]): r["days"] for r in run_summary(store.ledger(), run="LOAD_BATCH_ID").collect()}
    assert by_run == {("20260109060708", "loaded"): 1, ("20260109060709", "failed"): 1}
    assert [r["STATUS"] for r in current_status(store.ledger()).collect()] == ["failed"]


def test_yesterday(spark, tmp_path):
    assert schedule_yesterday(datetime(2026, 1, 6, 4, 59, tzinfo=timezone.utc)) == "01/04/2026"
    assert schedule_yesterday(datetime(2026, 1, 6, 5, 1)) == "01/05/2026"
    store = Store(spark, str(tmp_path / "store"))
    load_yesterday(Landing(spark, simple().write(tmp_path / "a")), store, datetime(2026, 1, 6, 12))
    assert store.log().count() == 2


def test_too_many_days(spark, tmp_path):
    with pytest.raises(ValueError, match="8 days"):
        load_days(Landing(spark, "x"), Store(spark, "y"), "01/01/2026", "01/08/2026", NOW)


def test_audits(loaded):
    _, store, _, _ = loaded
    log = store.log()
    health = data_health(log, date(2026, 1, 4), date(2026, 1, 8), [date(2026, 1, 7)])
    assert [r[0].day for r in health.missing.collect()] == [4, 6]
    assert health.duplicates.count() == 0
    assert [tuple(r)[1:] for r in health.status.collect()] == [(6, 6, 0), (2, 2, 0)]
    integrity = game_integrity(log, date(2026, 1, 5))
    assert integrity.team_counts.count() == 0
    assert integrity.low_team_players.count() == 4
    assert integrity.low_game_players.count() == 2
    assert integrity.corrupted.count() == 0
    center = command_center(log, date(2025, 10, 21), date(2026, 1, 7)).first()
    assert center.asDict() == {
        "last_game_date": date(2026, 1, 8), "expected_latest": date(2026, 1, 7), "days_behind": -1,
        "total_rows": 6, "total_games": 2, "unique_players": 6, "partition_count": 1,
    }


def test_arena_build(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    build_arena_dimension(store, NOW)
    build_arena_dimension(store, NOW)
    assert store.arenas(NOW).count() == store.arenas(NOW).select("TEAM_ID").distinct().count() == 30
    assert store.arenas(NOW).where(F.col("ARENA_NAME").isNull()).count() == 0


def test_pieces_of_a_run_are_whole_dates():
    days = [date(2026, 1, k) for k in range(1, 6)]
    assert day_load.piece_starts(zip(days, [3, 3, 9, 1, 1], strict=True), 6) == [days[2], days[3]]
    assert day_load.piece_starts([(days[0], 9)], 6) == [] and day_load.piece_starts([], 6) == []


def test_a_run_in_pieces_gives_what_a_whole_one_gives(spark, tmp_path, monkeypatch):
    landing = Landing(spark, landed_days().write(tmp_path / "landing"))
    found, joined, assemble = [], [], A.assemble
    monkeypatch.setattr(A, "assemble", lambda *frames: joined.append(1) or assemble(*frames))
    for games in (1, 100):
        store = Store(spark, str(tmp_path / f"store{games}"))
        build_player_dimension(store, landing.season_players(), landing.player_info(), NOW)
        result = load_days(landing, store, "12/01/2025", "01/31/2026", NOW, max_days=None, piece_games=games)
        assert not Path(f"{result.folder}/data").exists()
        reports = (result.gates, result.ledger, result.null_columns, result.repeated_keys, result.missing_games, result.rejects.drop("file"))
        found.append([sorted(map(str, frame.collect())) for frame in (store.log(), store.state(), *reports)])
    assert found[0] == found[1] and len(found[0][0]) == 8
    assert len(joined) == 3 + 1


def test_a_piece_is_published_before_the_next_one_is_joined(spark, tmp_path, monkeypatch):
    landing, store = Landing(spark, landed_days().write(tmp_path / "landing")), Store(spark, str(tmp_path / "store"))
    build_player_dimension(store, landing.season_players(), landing.player_info(), NOW)
    scratch = Path(spark.conf.get("spark.checkpoint.dir"), "courtside")
    before, held, assemble = set(scratch.glob("load-*/data/rows/*")), [], A.assemble

    def watched(*frames):
        held.append((len(set(scratch.glob("load-*/data/rows/*")) - before), store.log().count() if len(held) else 0))
        return assemble(*frames)

    monkeypatch.setattr(A, "assemble", watched)
    load_days(landing, store, "12/01/2025", "01/31/2026", NOW, max_days=None, piece_games=1)
    assert [rows for rows, _ in held] == [0, 0, 0]
    assert held[0][1] == 0 < held[1][1] <= held[2][1]


def test_jobs_leave_no_shuffle_files(spark, tmp_path):
    def files():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {block.toString() for block in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllBlocks())}

    setting, before = spark.conf.get(_SHUFFLES_GO), files()
    with shuffles_dropped(spark):
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "rows"))
    assert files() <= before and spark.conf.get(_SHUFFLES_GO) == setting
    spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "more"))


def test_one_game_endpoint_of_the_tables_lies_landed_at_a_time(spark, monkeypatch, tmp_path):
    from courtside.session import exists
    from courtside.workload import landed

    land, there = landed._land, []
    tables = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where("o_orderdate between '1996-01-06' and '1996-01-12'")
    tables.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.read.parquet("/root/testdata/sf0.001/customer.parquet").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")

    def recorded(spark, sf_dir, name, root):
        land(spark, sf_dir, name, root)
        there.append([n for n in landed.DATED if exists(spark, f"{root}/{n}")])

    monkeypatch.setattr(landed, "_land", recorded)
    monkeypatch.setattr(landed, "_landings", {})
    _, result = landed.load_all(spark, str(tmp_path))
    assert result.ledger.where("STATUS = 'loaded'").count() and len(there) == 8 and max(map(len, there)) == 1
