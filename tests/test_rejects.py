import json
from datetime import date, datetime, timezone
from pathlib import Path

import pytest

from courtside.plans.day_load import load_days
from courtside.sources.landing import Landing, rejected
from courtside.sources.store import Store
from fixtures import DAY1, DAY2, DAY4, Landed, player

NOW = datetime(2026, 1, 9, 6, 7, 8, tzinfo=timezone.utc)
DATED = ("scoreboard", "traditional", "advanced", "usage", "four_factors", "live")


def landed_days():
    landed = Landed()
    for day, game in ((DAY1, "1"), (DAY2, "2"), (DAY4, "4")):
        landed.scoreboard(day, game)
        landed.game(day, game, [player(1)], [player(2)])
    landed.info(1, 2)
    return landed


def by_date(landed, root):
    """The same landing in folders by date."""
    for name, rows in landed.files.items():
        for row in rows:
            folder = root / name / (f"game_date={row['game_date']}" if name in DATED else "")
            folder.mkdir(parents=True, exist_ok=True)
            with open(folder / "part.json", "a") as out:
                out.write(json.dumps({k: v for k, v in row.items() if k != "game_date"}) + "\n")
    (root / "season_players").mkdir(parents=True, exist_ok=True)
    return str(root)


def load(spark, root, tmp_path, name="s", days=("01/05/2026", "01/08/2026")):
    store = Store(spark, str(tmp_path / name))
    return store, load_days(Landing(spark, root), store, *days, NOW)


def status(result):
    return {str(r["GAME_DATE"]): r["STATUS"] for r in result.ledger.collect()}


def failed(result):
    return {(str(r["GAME_DATE"]), r["gate"]): r["bad_rows"] for r in result.gates.where("not pass").collect()}


@pytest.mark.parametrize("endpoint", DATED[1:])
def test_a_broken_line_is_kept_and_named(spark, tmp_path, endpoint):
    root = Path(landed_days().write(tmp_path / "l"))
    lines = (root / endpoint / "part.json").read_text().splitlines()
    at = next(k for k, line in enumerate(lines) if DAY2 in line)
    lines[at] = lines[at][:-3]
    (root / endpoint / "part.json").write_text("\n".join(lines) + "\n")
    store, result = load(spark, str(root), tmp_path)
    assert status(result) == {DAY1: "loaded", DAY2: "failed", DAY4: "loaded"}
    assert (DAY2, "rejected_line") in failed(result)
    kept = [tuple(r) for r in result.rejects.select("endpoint", "GAME_DATE", "GAME_ID", "line", "reason").collect()]
    assert kept == [(endpoint, date.fromisoformat(DAY2), "2", lines[at], "malformed")]
    assert result.rejects.first()["file"].endswith(f"{endpoint}/part.json")
    assert [r["LOAD_BATCH_ID"] for r in store.rejects().collect()] == ["20260109060708"]


def test_reasons(spark, tmp_path):
    landed = landed_days()
    landed.files["advanced"] += [{"game_date": DAY1}, {"game_id": "1", "boxScoreAdvanced": {}}, {"game_date": DAY1, "game_id": "1"}]
    landed.files["player_info"] += [{"POSITION": "Guard"}]
    root = Path(landed.write(tmp_path / "l"))
    with open(root / "usage" / "part.json", "a") as out:
        out.write("not json at all\n")
    _, result = load(spark, str(root), tmp_path)
    found = {(r["endpoint"], r["reason"], None if r["GAME_DATE"] is None else str(r["GAME_DATE"])) for r in result.rejects.collect()}
    assert found == {
        ("advanced", "no game id", DAY1), ("advanced", "no date", None), ("advanced", "no payload", DAY1), ("usage", "malformed", None),
        ("player_info", "no player id", None),
    }
    # lines that name no date count against none
    assert failed(result) == {(DAY1, "rejected_line"): 2}
    assert json.loads(result.rejects.where("reason = 'no payload'").first()["line"]) == {"game_date": DAY1, "game_id": "1"}


def test_a_rejected_line_of_an_unlisted_game_fails_no_date(spark, tmp_path):
    landed = landed_days()
    landed.files["live"].append({"game_date": DAY1, "game_id": "99"})
    _, result = load(spark, landed.write(tmp_path / "l"), tmp_path)
    assert set(status(result).values()) == {"loaded"} and [r["GAME_ID"] for r in result.rejects.collect()] == ["99"]


def test_scoreboard_lines_are_kept_too(spark, tmp_path):
    landed = landed_days()
    landed.files["scoreboard"].append({"game_date": DAY2, "scoreboard": {}})
    _, result = load(spark, landed.write(tmp_path / "l"), tmp_path)
    assert failed(result) == {(DAY2, "scoreboard_payload"): 1}
    assert [(r["endpoint"], r["reason"]) for r in result.rejects.collect()] == [("scoreboard", "no games")]


def test_clean_landings_reject_nothing(spark, tmp_path):
    store, result = load(spark, landed_days().write(tmp_path / "l"), tmp_path)
    assert result.rejects.count() == 0 and store.rejects().count() == 0 and set(status(result).values()) == {"loaded"}


def test_only_the_folders_of_the_run_are_read(spark, tmp_path):
    landed = landed_days()
    root = by_date(landed, tmp_path / "l")
    flat = landed.write(tmp_path / "flat")
    for name in DATED:  # a file of another date that can not be read as JSON, in a folder that must not be opened
        other = tmp_path / "l" / name / "game_date=2025-12-31"
        other.mkdir()
        (other / "part.json").write_text("{broken\n")
    landing = Landing(spark, root).of_days(date(2026, 1, 5), date(2026, 1, 6))
    files = landing.checked("traditional").inputFiles()
    assert sorted(f.rsplit("/", 2)[1] for f in files) == [f"game_date={DAY1}", f"game_date={DAY2}"]
    plan = landing.traditional().where(f"game_date = date'{DAY1}'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(game_date" in plan
    days = ("01/05/2026", "01/06/2026")
    parts, _ = load(spark, root, tmp_path, "a", days)
    whole, _ = load(spark, flat, tmp_path, "b", days)
    assert sorted(map(str, parts.log().collect())) == sorted(map(str, whole.log().collect())) and parts.log().count() == 4


def test_a_run_without_folders_loads_nothing(spark, tmp_path):
    root = by_date(landed_days(), tmp_path / "l")
    store, result = load(spark, root, tmp_path, days=("02/05/2026", "02/06/2026"))
    assert result.ledger.count() == 0 and result.gates.count() == 0 and store.log().count() == 0


def test_broken_lines_in_folders_have_their_date(spark, tmp_path):
    root = by_date(landed_days(), tmp_path / "l")
    with open(f"{root}/usage/game_date={DAY4}/part.json", "a") as out:
        out.write("{\n")
    _, result = load(spark, root, tmp_path)
    assert failed(result) == {(DAY4, "rejected_line"): 1}
    assert [(str(r["GAME_DATE"]), r["GAME_ID"]) for r in rejected_rows(spark, root)] == [(DAY4, None)]


def rejected_rows(spark, root):
    return rejected(Landing(spark, root).checked("usage"), "usage", "game_date", "game_id").collect()
