"""Hand-made landed payloads of three dates, in the shapes of FIXTURES.md."""

import json
from pathlib import Path

from courtside import schema as S

HOME, AWAY = 1610612738, 1610612747
DAY1, DAY2, DAY3, DAY4 = "2026-01-05", "2026-01-06", "2026-01-07", "2026-01-08"


def names(text):
    return S.struct_of(text).names


def player(pid, points=10, minutes="10:00", **extra):
    stats = {n: 1 for n in names(S.TRADITIONAL)} | {"points": points, "minutes": minutes}
    return {"personId": str(pid), "displayName": f"Player {pid}", "statistics": stats | extra}


def other(pid, text):
    return {"personId": str(pid), "statistics": {n: 0.5 for n in names(text)} | {"minutes": "10:00"}}


def live(day, game, home_score=100, away_score=90, officials=3):
    return {
        "game_date": day,
        "game_id": game,
        "game": {
            "homeTeam": {"teamId": HOME, "teamTricode": "BOS", "score": home_score},
            "awayTeam": {"teamId": AWAY, "teamTricode": "LAL", "score": away_score},
            "gameStatusText": "Final",
            "gameTimeUTC": f"{day}T00:00:00Z",
            "officials": [{"personId": 900 + i, "name": f"Ref {i}"} for i in range(officials)],
        },
    }


def factors(day, game):
    stats = {n: 0.25 for n in names(S.FOUR_FACTORS)} | {"minutes": "240:00"}
    return {
        "game_date": day,
        "game_id": game,
        "boxScoreFourFactors": {
            "homeTeam": {"teamId": str(HOME), "statistics": stats},
            "awayTeam": {"teamId": str(AWAY), "statistics": stats},
        },
    }


def box(day, game, envelope, home, away):
    return {
        "game_date": day,
        "game_id": game,
        envelope: {
            "homeTeam": {"teamId": str(HOME), "teamTricode": "BOS", "players": home},
            "awayTeam": {"teamId": f"{AWAY}.0", "teamTricode": "LAL", "players": away},
        },
    }


class Landed:
    """Collects payloads of whole games and writes them as JSON lines."""

    def __init__(self):
        self.files = {
            name: []
            for name in (
                "scoreboard", "traditional", "advanced", "usage", "four_factors", "live",
                "season_players", "player_info",
            )
        }

    def scoreboard(self, day, *games):
        self.files["scoreboard"].append(
            {"game_date": day, "scoreboard": {"games": [{"gameId": g} for g in games]}}
        )

    def game(self, day, game, home, away, advanced=None, usage=None, **facts):
        self.files["traditional"].append(box(day, game, "boxScoreTraditional", home, away))
        for name, envelope, text, given in (
            ("advanced", "boxScoreAdvanced", S.ADVANCED, advanced),
            ("usage", "boxScoreUsage", S.USAGE, usage),
        ):
            sides = given or (
                [other(p["personId"], text) for p in home],
                [other(p["personId"], text) for p in away],
            )
            self.files[name].append(box(day, game, envelope, *sides))
        self.files["four_factors"].append(factors(day, game))
        self.files["live"].append(live(day, game, **facts))

    def info(self, *ids):
        self.files["player_info"] += [
            {"PLAYER_ID": i, "POSITION": "Guard", "HEIGHT": "6-5", "SEASON_EXP": str(i % 7)} for i in ids
        ]

    def season(self, *ids):
        self.files["season_players"] += [{"PERSON_ID": str(i)} for i in ids]

    def write(self, root):
        for name, rows in self.files.items():
            folder = Path(root) / name
            folder.mkdir(parents=True)
            (folder / "part.json").write_text("".join(json.dumps(row) + "\n" for row in rows))
        return str(root)
