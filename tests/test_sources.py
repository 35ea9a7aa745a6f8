import glob
import os
from datetime import datetime, timezone

import pytest

from courtside import schema as S
from courtside.operators.shape import fill_missing
from courtside.sources.export_csv import read_export, write_export
from courtside.sources.landing import Landing, player_attributes, season_player_ids
from courtside.sources.store import Store
from fixtures import DAY1, DAY2, Landed, player
from courtside.operators import payloads
from courtside.workload import landed

NOW = datetime(2026, 1, 9, tzinfo=timezone.utc)


def test_export_types_and_leading_zeros(spark, tmp_path):
    cells = dict.fromkeys(S.PLAYER_GAME.names, "")
    cells |= {
        "PLAYER_ID": "1629130", "GAME_ID": "22500953", "ROW_KEY": "0022500953_1629130", "GAME_DATE": "2026-03-12",
        "HOME_FLAG": "TRUE", "DNP_FLAG": "FALSE", "minutes": "24:44", "PIE_ADV": "0.181",
        "INGESTED_AT_UTC": "2026-03-14 05:20:56.820234 UTC",
    }
    (tmp_path / "export.csv").write_text(",".join(cells) + "\n" + ",".join(cells.values()) + "\n")
    read = read_export(spark, str(tmp_path / "export.csv"))
    assert read.schema == S.PLAYER_GAME
    row = read.selectExpr("*", "unix_micros(INGESTED_AT_UTC) as micros").first()
    assert row["GAME_ID"] == "0022500953" and row["HOME_FLAG"] is True and row["DNP_FLAG"] is False
    assert row["micros"] == 1773465656820234
    assert str(row["GAME_DATE"]) == "2026-03-12" and row["points"] is None


def test_store_creates_its_tables_once(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for _ in range(2):
        store.create_log()
        store.create_players()
        store.create_arenas()
    assert store.log().schema.names == S.PLAYER_GAME.names
    assert store.log().count() == store.players().count() == store.arenas(NOW).count() == 0


def test_arenas_are_built_when_absent(spark, tmp_path):
    assert Store(spark, str(tmp_path)).arenas(NOW).where("TEAM_TRICODE = 'BOS'").first()["ARENA_CITY"] == "Boston"


def test_append_adds_each_player_once(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create_players()
    info = spark.createDataFrame(
        [(1, "G", "6-1", "2"), (1, "G", "6-1", "2"), (2, None, None, None)], S.PLAYER_INFO
    )
    wanted = spark.createDataFrame([(1,), (2,), (3,)], "PLAYER_ID bigint")
    for _ in range(2):
        store.append_players(player_attributes(info, wanted), NOW)
    assert sorted(map(str, store.players().collect())) == sorted(
        ["Row(PLAYER_ID=1, POSITION='G', HEIGHT='6-1', EXP='2')", "Row(PLAYER_ID=2, POSITION=None, HEIGHT=None, EXP=None)"]
    )


def test_season_ids(spark):
    listed = spark.createDataFrame([("1",), ("1.0",), ("x",), (None,)], S.SEASON_PLAYERS)
    assert [r[0] for r in season_player_ids(listed).collect()] == [1]


def test_landing_partitioned_by_date(spark, tmp_path):
    landed = Landed()
    for day in (DAY1, DAY2):
        landed.scoreboard(day, f"g{day}")
        landed.game(day, f"g{day}", [player(1)], [player(2)])
    flat = Landing(spark, landed.write(tmp_path / "flat"))
    flat.traditional().write.partitionBy("game_date").json(str(tmp_path / "parts/traditional"))
    parts = Landing(spark, str(tmp_path / "parts"))
    columns = ["GAME_DATE", "GAME_ID", "PLAYER_ID", "points"]

    def rows(landing):
        found = payloads.player_rows(landing.traditional(), [S.TRADITIONAL_ENVELOPE])
        return sorted(map(tuple, found.select(*columns).collect()))

    assert rows(parts) == rows(flat) and len(rows(flat)) == 4
    plan = parts.traditional().where(f"game_date = date'{DAY1}'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(game_date" in plan


def test_absent_payload_parts(spark, tmp_path):
    landed = Landed()
    landed.files["traditional"] = [
        {"game_date": DAY1, "game_id": "1", "boxScoreTraditional": {"homeTeam": {"teamId": "5", "players": [player(1)]}}},
        {"game_date": DAY1, "game_id": "2", "boxScoreTraditional": {"homeTeam": {"teamId": "5"}, "awayTeam": {}}},
        {"game_date": DAY1, "game_id": "3"},
    ]
    landed.files["live"] = [{"game_date": DAY1, "game_id": "1"}]
    landing = Landing(spark, landed.write(tmp_path / "landing"))
    rows = payloads.player_rows(landing.traditional(), [S.TRADITIONAL_ENVELOPE]).collect()
    assert [(r["GAME_ID"], r["PLAYER_ID"], r["TEAM_ID"], r["TEAM_TRICODE"]) for r in rows] == [("1", 1, 5, None)]
    live = payloads.live_game_rows(landing.live()).first()
    assert live["GAME_ID"] == "1" and live["HOME_TEAM_ID"] is None and live["REFEREE_1_ID"] is None


def test_fill_missing_keeps_extra_columns(spark):
    assert "extra" in fill_missing(spark.range(1).withColumnRenamed("id", "extra")).columns


def test_landings_are_compressed_and_written_as_asked_for(spark):
    """Orders move, not payloads: no exchange or sort below a write has a payload in it."""
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("the given tables are absent")
    landed._landings.clear()
    landing = landed.landing_of(spark, "/root/testdata/sf0.001", "scoreboard")
    written = glob.glob(f"{landing.root}/**/part-*", recursive=True)
    assert written and all("/scoreboard/" in f and f.endswith(".json.gz") for f in written)
    for name, payload in landed.payloads_of(spark, "/root/testdata/sf0.001", by_date=True).items():
        plan = payload._jdf.queryExecution().optimizedPlan().toString()
        moved = plan[plan.index("Repartition") :] if name in landed.DATED else ""
        assert "struct(" not in moved and "named_struct" not in moved, name
    assert landed.landing_of(spark, "/root/testdata/sf0.001").root == landing.root
    assert sorted(os.listdir(landing.root)) == sorted([*landed.DATED, "season_players", "player_info"])


def test_compressed_exports_read_back(spark, tmp_path):
    rows = fill_missing(spark.createDataFrame([("0022500001", 7)], "GAME_ID string, PLAYER_ID long")).select(*S.PLAYER_GAME.names)
    write_export(rows, str(tmp_path / "plain"))
    write_export(rows, str(tmp_path / "small"), "gzip")
    assert glob.glob(f"{tmp_path}/small/*.csv.gz") and glob.glob(f"{tmp_path}/plain/*.csv")
    assert read_export(spark, str(tmp_path / "small")).collect() == read_export(spark, str(tmp_path / "plain")).collect()


def test_a_load_of_all_dates_lands_few_files(spark, tmp_path):
    """Without a folder by date, so that thousands of dates aren't as many files; the rows are those of the folders."""
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("the given tables are absent")
    tables = "/root/testdata/sf0.001"
    flat = landed.LandingAtNeed(spark, str(tmp_path / "flat"), sf_dir=tables)
    rows = {name: flat.checked(name).drop("reject") for name in ("four_factors", "live")}
    for name in rows:
        files = glob.glob(f"{tmp_path}/flat/{name}/**/part-*", recursive=True)
        assert files and len(files) <= spark.sparkContext.defaultParallelism and all(f.endswith(".json.gz") for f in files)
        landed._land_by_date(spark, tables, name, str(tmp_path / "dated"))
        dated = Landing(spark, str(tmp_path / "dated")).checked(name).drop("reject")
        assert sorted(map(str, dated.collect())) == sorted(map(str, rows[name].collect()))


def test_only_asked_for_payloads_are_made(spark, monkeypatch):
    monkeypatch.setattr(landed, "_box", lambda *a: pytest.fail("a box score is made"))
    if os.path.isdir("/root/testdata/sf0.001"):
        assert list(landed.payloads_of(spark, "/root/testdata/sf0.001", names=["live"])) == ["live"]


def test_payloads_of_one_file_are_made_in_many_tasks(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("the given tables are absent")
    made = landed.payloads_of(spark, "/root/testdata/sf0.001", names=["scoreboard"])["scoreboard"]
    assert "Repartition" in made._jdf.queryExecution().optimizedPlan().toString()
