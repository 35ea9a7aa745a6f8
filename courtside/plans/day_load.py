"""Loading landed dates into the store: many dates in one job, each date passing or failing alone.

Endpoints are parsed once and staged as flat parquet in the shared scratch folder. Later steps read
only the columns they need from there, and a lost executor never leads back to the JSON. Dates that
break a cardinality are known before the wide joins run, so those joins need no guard of their own.

What moves wide rows, from the joins over the gates to the published dates, is done for a piece of the dates at a time, of a bounded
number of games or of one date, so the wide rows of a single piece are staged. The shuffle files of a job and what was staged for a
piece are deleted when they were used.
"""

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import partial, reduce, wraps
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside import schema as S
from courtside.functions import calendar
from courtside.functions.columns import batch_id, row_key
from courtside.operators import audits, gates, payloads
from courtside.operators.joins import missing_from
from courtside.plans import assemble as A
from courtside.session import discard, scratch_folder, shuffles_dropped
from courtside.sources.landing import REJECT, Landing, for_days, player_attributes, rejected, sound
from courtside.sources.store import Store

LOADED, FAILED = "loaded", "failed"
NULL_CELLS = "null_cells"
PAYLOAD_GATES = ["scoreboard_payload", "unidentified_game", "rejected_line", "missing_game", "repeated_key"]
# Runs of up to so many calendar days have their rows counted while they are written.
OBSERVED_DAYS = 4 * calendar.DAYS_PER_BATCH
# Longer runs are joined and published in pieces of whole dates, of about so many listed games.
PIECE_GAMES = 1_000_000
PIECE = "load_piece"


@dataclass(frozen=True)
class LoadResult:
    """The gate report and the ledger rows of one run, and why its dates failed.

    `null_columns` has the columns with missing values per failed date, `repeated_keys` up to five keys per
    date, `missing_games` the listed games without player rows, `rejects` the landed lines that could not be used.
    """

    gates: DataFrame
    ledger: DataFrame
    null_columns: DataFrame
    repeated_keys: DataFrame
    missing_games: DataFrame
    rejects: DataFrame
    folder: str


def _utc(moment: datetime) -> datetime:
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def _per_day(frame: DataFrame, name: str, day: str = "GAME_DATE") -> DataFrame:
    return frame.groupBy(day).agg(F.count(F.lit(1)).alias(name))


def piece_starts(sizes: Iterable[tuple[date, int]], most: int) -> list[date]:
    """The dates, but the first, at which pieces of at most so many games begin; a date with more is a piece of its own."""
    starts, held = [], 0
    for day, games in sorted(sizes):
        if held and held + games > most:
            starts.append(day)
            held = 0
        held += games
    return starts


def piece_of(day: Column, starts: Sequence[date]) -> Column:
    """The number of the piece that a date is in; 0 for a null date."""
    return sum((F.coalesce(day >= F.lit(start).cast("date"), F.lit(False)).cast("int") for start in starts), F.lit(0))


def _dropping_shuffles(load: Callable[..., LoadResult]) -> Callable[..., LoadResult]:
    @wraps(load)
    def run(landing: Landing, *args, **options) -> LoadResult:
        with shuffles_dropped(landing.spark):
            return load(landing, *args, **options)

    return run


@_dropping_shuffles
def load_days(
    landing: Landing,
    store: Store,
    start: str,
    end: str,
    ingested_at: datetime,
    excluded: Iterable[str] = (),
    max_days: int | None = calendar.MAX_DAYS_PER_RUN,
    day_batch: int = calendar.DAYS_PER_BATCH,
    keep_staged: bool = False,
    piece_games: int = PIECE_GAMES,
) -> LoadResult:
    """Load the dates from start to end (MM/DD/YYYY) except the excluded ones, after some four weeks in pieces of `piece_games`.

    A date that fails a gate is recorded as failed and keeps its stored partition; the others are
    replaced. A date without listed games is not recorded at all. The staged rows are deleted after the load unless
    `keep_staged`; the reports stay in the result's folder.
    """
    spark = landing.spark
    first, last, skipped = calendar.parse_range(start, end, excluded)
    calendar.check_day_cap(first, last, skipped, max_days)
    moment = _utc(ingested_at)
    batch = batch_id(moment)
    folder = scratch_folder(spark, f"load-{batch}")

    def staged(name: str, df: DataFrame, kind: str = "data") -> DataFrame:
        path = f"{folder}/{kind}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    landing = landing.of_days(first, last)

    def landed(payload: DataFrame) -> DataFrame:
        return for_days(payload, first, last, skipped, undated=True)

    # A scoreboard line without a date might belong to any date, so it stops the run.
    boards = staged("boards", payloads.board_lines(landed(landing.checked_scoreboard())))
    dateless = boards.where("GAME_DATE is null").count()
    if dateless:
        raise ValueError(f"{dateless} scoreboard lines are malformed or without a date")
    landing.used("scoreboard")
    games = payloads.listed_games(boards)
    bad_boards, unidentified = boards.where("broken"), games.where("GAME_ID is null")
    listed = games.where("GAME_ID is not null").distinct()

    span = calendar.days_between(first, last, skipped)
    short = len(span) <= OBSERVED_DAYS
    starts = [] if short else piece_starts(map(tuple, _per_day(listed, "games").collect()), piece_games)

    def staged_pieces(name: str, df: DataFrame) -> DataFrame:
        """With the number of the piece as a column, by which it lies in folders."""
        if not starts:
            return staged(name, df).withColumn(PIECE, F.lit(0))
        path = f"{folder}/data/{name}"
        numbered = df.withColumn(PIECE, piece_of(F.col("GAME_DATE"), starts))
        numbered.write.option("compression", "zstd").partitionBy(PIECE).parquet(path)
        return spark.read.schema(numbered.schema).parquet(path)

    # Each endpoint is parsed once; its rejected lines are staged beside its rows. Only listed games are loaded: the other
    # endpoints are joined to the traditional rows, so theirs are left out by the way.
    boxes = {"traditional": S.TRADITIONAL_ENVELOPE, "advanced": S.ADVANCED_ENVELOPE, "usage": S.USAGE_ENVELOPE}
    known = listed.withColumn("listed", F.lit(True))
    flat = {name: partial(payloads.player_rows, envelopes=[envelope]) for name, envelope in boxes.items()}
    flat |= {"four_factors": payloads.team_factor_rows, "live": payloads.live_game_rows}
    parsed = {}
    for name, rows_of in flat.items():
        rows = rows_of(landed(landing.checked(name)))
        if name == "traditional":
            rows = rows.join(known, A.GAME, "left").where(F.col("listed") | F.col(REJECT).isNotNull()).drop("listed")
        parsed[name] = staged_pieces(name, rows)
        landing.used(name)
    traditional, advanced, usage, factors, live = map(sound, parsed.values())
    lost = reduce(DataFrame.unionByName, [rejected(rows, name) for name, rows in {"scoreboard": boards, **parsed}.items()])

    keyed = {
        "games": (games.where("GAME_ID is not null").withColumn(PIECE, piece_of(F.col("GAME_DATE"), starts)), A.GAME),
        "traditional": (traditional, payloads.STAT_KEYS),
        "advanced": (advanced, payloads.STAT_KEYS),
        "usage": (usage, payloads.STAT_KEYS),
        "four_factors": (factors, A.GAME_TEAM),
        "live": (live, A.GAME),
    }

    def by_piece(name: str, made: Callable[[int], DataFrame]) -> DataFrame:
        """What is made of each piece, staged one after the other, so that one piece at a time is shuffled."""
        return reduce(DataFrame.unionByName, [staged(f"{name}/{k}", made(k)) for k in range(len(starts) + 1)])

    def listed_in(k: int) -> DataFrame:
        return listed.where(piece_of(F.col("GAME_DATE"), starts) == k)

    def repeats_in(k: int) -> DataFrame:
        here = {name: (rows.where(F.col(PIECE) == k).select(*keys), keys) for name, (rows, keys) in keyed.items()}
        return A.repeated_examples(here, most=None, games=listed_in(k))

    # A rejected line counts against its date unless it is known to be of a game that no scoreboard lists.
    blamed = lost.where("endpoint <> 'scoreboard' and GAME_DATE is not null")
    blamed = blamed.join(known, A.GAME, "left").where("GAME_ID is null or listed")
    missing = by_piece("missing", lambda k: missing_from(listed_in(k), traditional.where(F.col(PIECE) == k), A.GAME))
    missing = staged("missing_games", missing, "report")
    repeats = by_piece("repeats", repeats_in)
    repeated = staged("repeated_keys", A.first_examples(repeats), "report")
    days = boards.where("broken or size(game_ids) > 0").select("GAME_DATE").distinct()
    checks = [
        _per_day(bad_boards, "scoreboard_payload"),
        _per_day(unidentified, "unidentified_game"),
        _per_day(blamed, "rejected_line"),
        _per_day(missing, "missing_game"),
        _per_day(repeats, "repeated_key"),
    ]
    payload_counts = staged(
        "payload_gates",
        reduce(lambda a, b: a.join(b, "GAME_DATE", "left"), checks, days).fillna(0, PAYLOAD_GATES),
    )
    payload_report = gates.long_report(payload_counts, PAYLOAD_GATES)
    # One row per calendar day of the run at most, which bounds the broadcast.
    bad_days = F.broadcast(staged("bad_days", payload_report.where("not pass").select("GAME_DATE").distinct()))
    good_days = payload_counts.select("GAME_DATE").join(bad_days, "GAME_DATE", "left_anti")
    traditional, advanced, usage, factors, live = (
        rows.join(bad_days, "GAME_DATE", "left_anti") for rows in (traditional, advanced, usage, factors, live)
    )

    # Players the dimension lacks are added before the one join to it.
    store.create_players()
    absent = staged("absent_players", missing_from(traditional.select("PLAYER_ID"), store.players(), ["PLAYER_ID"]))
    if not absent.isEmpty():
        wanted = absent.withColumn("wanted", F.lit(True))
        info = landing.checked_info().join(wanted, "PLAYER_ID", "left").where(F.col("wanted") | F.col(REJECT).isNotNull())
        info = staged("player_info", info.drop("wanted"))
        store.append_players(player_attributes(sound(info), absent), moment)
        lost = lost.unionByName(rejected(info, "player_info"))
    lost = staged("rejects", lost, "report")
    store.create_log()
    reports, nulls, verified = [], [], []
    for k in range(len(starts) + 1):
        own = (frame.where(F.col(PIECE) == k).drop(PIECE) for frame in (traditional, advanced, usage, factors, live))
        described = A.with_dimensions(A.assemble(*own), store.players(), store.arenas(moment))
        complete = A.finished(described, moment)
        gates.check_columns(complete.columns)
        # Nulls are counted while the wide rows are at hand, in short runs the other gates too, so these need not be read back.
        complete = complete.withColumn(NULL_CELLS, gates.null_cells(complete))
        if short:
            # Every row comes of one traditional row, so these have the row keys.
            observed = gates.ObservedDays(span)
            rows = staged(f"rows/{k}", observed.watch(complete, F.col(NULL_CELLS)))
            keys = traditional.select("GAME_DATE", row_key(F.col("GAME_ID"), F.col("PLAYER_ID")).alias("ROW_KEY"))
            found = observed.counts(spark, keys)
        else:
            rows = staged(f"rows/{k}", complete)
            found = gates.day_counts(rows, counted_nulls=NULL_CELLS)
        counts = staged(f"day_counts/{k}", found)
        for name in () if keep_staged else parsed:
            discard(spark, f"{folder}/data/{name}/{PIECE}={k}" if starts else f"{folder}/data/{name}")

        own_days = good_days.where(piece_of(F.col("GAME_DATE"), starts) == k)
        reports.append(staged(f"row_gates/{k}", gates.gate_report(counts, own_days)))
        failing = reports[k].where("not pass").select("GAME_DATE").distinct()
        kept = rows.drop(NULL_CELLS)
        lacking = rows.where(F.col(NULL_CELLS) > 0).drop(NULL_CELLS)
        found = gates.null_profile_by_day(lacking.join(F.broadcast(failing), "GAME_DATE", "left_semi"))
        nulls.append(staged(f"null_columns/{k}", found))
        expected = staged(f"passing/{k}", counts.select("GAME_DATE", "rows").join(failing, "GAME_DATE", "left_anti"))
        verified.append(store.publish_days(kept, expected, batch).where("pass"))
        served = F.broadcast(verified[k].select("GAME_DATE"))
        store.publish_state(audits.game_state(rows.join(served, "GAME_DATE", "left_semi")), batch)
        if not keep_staged:
            discard(spark, f"{folder}/data/rows/{k}")
    report = staged("gates", reduce(DataFrame.unionByName, reports, payload_report), "report")
    nulls = staged("null_columns", reduce(DataFrame.unionByName, nulls), "report")
    verified = reduce(DataFrame.unionByName, verified)
    numbers = calendar.number_batches(calendar.run_days(spark, first, last, skipped), day_batch)
    ledger = staged(
        "ledger",
        payload_counts.select("GAME_DATE")
        .join(numbers, "GAME_DATE", "left")
        .join(verified, "GAME_DATE", "left")
        .select(
            "GAME_DATE",
            F.when(F.col("pass"), LOADED).otherwise(FAILED).alias("STATUS"),
            F.coalesce("stored_rows", F.lit(0)).alias("ROWS"),
            F.lit(batch).alias("LOAD_BATCH_ID"),
            "BATCH_NO",
        ),
        "report",
    )
    store.append_ledger(ledger)
    store.append_rejects(lost, batch)
    if not keep_staged:
        discard(spark, f"{folder}/data")
    return LoadResult(report, ledger, nulls, repeated, missing, lost, folder)


def schedule_yesterday(now: datetime) -> str:
    """The day before the Eastern date of a moment, as MM/DD/YYYY."""
    eastern = _utc(now).astimezone(ZoneInfo(calendar.SCHEDULE_ZONE))
    return (eastern - timedelta(days=1)).strftime(calendar.DATE_TEXT)


def load_yesterday(landing: Landing, store: Store, now: datetime, excluded: Iterable[str] = ()) -> LoadResult:
    """The daily run: the schedule's yesterday as seen from `now`."""
    day = schedule_yesterday(now)
    return load_days(landing, store, day, day, now, excluded)
