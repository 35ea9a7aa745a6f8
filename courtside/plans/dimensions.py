"""Builds of the two dimensions."""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from courtside.operators.audits import season_coverage
from courtside.operators.joins import missing_from
from courtside.sources.arenas import arena_rows
from courtside.sources.landing import player_attributes
from courtside.sources.store import Store

PLAYER = ["PLAYER_ID"]


@dataclass(frozen=True)
class PlayerBuild:
    """Coverage in one row, and the season's ids that are still absent, in order."""

    coverage: DataFrame
    still_missing: DataFrame


def backfill_players(store: Store, wanted: DataFrame, info: DataFrame, updated_at: datetime) -> None:
    """Append the landed attributes of the wanted ids that the dimension lacks.

    Going by the id and not by an empty attribute, so a stored player is never added twice.
    """
    store.create_players()
    absent = missing_from(wanted, store.players(), PLAYER)
    if not absent.isEmpty():
        store.append_players(player_attributes(info, absent), updated_at)


def build_player_dimension(
    store: Store, season: DataFrame, info: DataFrame, updated_at: datetime
) -> PlayerBuild:
    backfill_players(store, season, info, updated_at)
    stored = store.players()
    return PlayerBuild(
        season_coverage(season, stored), missing_from(season, stored, PLAYER).orderBy(*PLAYER)
    )


def build_arena_dimension(store: Store, updated_at: datetime) -> None:
    """Replace the whole arena dimension."""
    store.create_arenas()
    store.replace_arenas(arena_rows(store.spark, updated_at))
