"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

Each text becomes `NAMES` statistics of its bytes, words and lines. They are standardised, cut at `CLIP`
deviations and mapped by random cosines, whose inner products approximate a Gaussian kernel. Every partition of
labelled rows sums its part of the normal equations, `SUMS` tasks add these up, and the driver solves.
Ridge scores of the labelled rows are counted in `BINS` bins with their labels, and a monotone fit
over the bins turns a score into a probability. All labelled rows of the training folds are used.

Null and empty texts have the statistics of no words and get a score like any text; an empty table gives
no rows; rows that repeat an id are scored each by its own text. Labels that are null, or whose id is null, are
left out of the fit. Without a label of both kinds there is nothing to learn, and every score is 0.5, so that nothing is rejected.
"""

from __future__ import annotations

import dataclasses
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.plaintext import cuts, parts
from courtside.llm.tables import columns_of, crc_fold, named, ship, staged, table

COSINES = 256
RIDGE = 1e-3
CLIP = 4.0
SUMS = 16
PIECE = 1 << 20
BINS = 512
SEED = 7

NAMES = (
    "log_bytes log_words log_lines mean_word sd_word upper lower digit space symbol high bar stop comma exclaim entropy "
    "distinct_words top_word repeated_next distinct_lines mean_line word_end_symbol capital_words all_upper one_letter"
).split()

_CLASS = np.full(256, 4)
_CLASS[128:] = 5
for _k, _part in enumerate((range(65, 91), range(97, 123), range(48, 58), (9, 10, 11, 12, 13, 32))):
    _CLASS[list(_part)] = _k
_LETTER_END = frozenset(range(48, 58)) | frozenset(range(65, 91)) | frozenset(range(97, 123)) | frozenset(range(128, 256))
_USUAL_END = _LETTER_END | frozenset(b".,;:?)\"'")


def statistics(text: str | None) -> np.ndarray:
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(len(NAMES))
    words = raw.split()
    if not words:
        out[0] = np.log1p(len(raw))
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, m = len(raw), len(words)
    kinds = np.bincount(_CLASS, counts, 6) / n
    lines = raw.split(b"\n")
    lengths = np.fromiter(map(len, words), np.int64, m)
    shares = counts[counts > 0] / n
    distinct = Counter(words)
    at = counts / n
    out[:3] = np.log1p((n, m, len(lines)))
    out[3:5] = np.log1p((lengths.mean(), lengths.std()))
    out[5:11] = kinds
    out[11:15] = np.sqrt((at[124], at[46], at[44], at[33]))
    out[15] = -(shares * np.log2(shares)).sum()
    out[16] = len(distinct) / m
    out[17] = max(distinct.values()) / m
    out[18] = sum(map(eq, words, words[1:])) / m
    out[19] = len(set(lines)) / len(lines)
    out[20] = np.log1p(n / len(lines))
    out[21] = sum(w[-1] not in _USUAL_END for w in words) / m
    out[22] = sum(65 <= w[0] <= 90 for w in words) / m
    out[23] = sum(map(bytes.isupper, words)) / m
    out[24] = (lengths == 1).mean()
    return out


@dataclasses.dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    turns: np.ndarray
    shifts: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    values: np.ndarray

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        z = np.cos(x @ self.turns + self.shifts) * np.sqrt(2 / len(self.shifts))
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.cosines(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.steps, self.values), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The weighted least-squares fit to y that never falls, x being in ascending order."""
    blocks: list[list[float]] = []
    for value, weight in zip(y, w, strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, k, c = blocks.pop()
            u = blocks[-1]
            u[0], u[1], u[2] = (u[0] * u[1] + v * k) / (u[1] + k), u[1] + k, u[2] + c
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and its statistics as an array."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts(batch, PIECE):
                found = [statistics(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "stats"]
                )

    rows = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"))
    return rows.mapInArrow(measure, "doc_id long, stats array<double>")


def _summed(rows: DataFrame, part) -> np.ndarray | None:
    """The sum over all partitions of an array of fixed size that `part` makes of (stats, labels); None without rows."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                own = part(np.stack(batch["stats"]), batch["y"].to_numpy(np.float64))
                total = own if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"total": [total.tobytes()]})

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for raw in batch["total"]:
                total = np.frombuffer(raw) if total is None else total + np.frombuffer(raw)
        if total is not None:
            yield pd.DataFrame({"total": [total.tobytes()]})

    found = rows.mapInPandas(add, "total binary").repartition(SUMS).mapInPandas(add_up, "total binary").collect()
    return np.sum([np.frombuffer(r.total) for r in found], axis=0) if found else None


def constant(value: float) -> QualityModel:
    """Gives every text the same score."""
    d = len(NAMES)
    weights = np.zeros(COSINES + 1)
    return QualityModel(np.zeros(d), np.ones(d), np.zeros((d, COSINES)), np.zeros(COSINES), weights, np.zeros(1), np.full(1, value))


def fit(stats: DataFrame, labels: DataFrame) -> QualityModel:
    """stats: doc_id, stats; labels: doc_id, y (0 or 1) of the rows to learn from."""
    rows = staged(stats.join(labels.where("y is not null"), "doc_id").select("stats", F.col("y").cast("double")), "training")
    d = len(NAMES)
    sums = _summed(rows, lambda x, y: np.concatenate([x.sum(0), (x * x).sum(0), [len(x), y.sum()]]))
    n, ones = sums[-2:] if sums is not None else (0, 0)
    if not 0 < ones < n:
        return constant(0.5)
    mean = sums[:d] / n
    scale = np.sqrt(np.maximum(sums[d : 2 * d] / n - mean**2, 1e-12)) + 1e-6
    rng = np.random.default_rng(SEED)
    turns = rng.normal(0, 1 / np.sqrt(2 * d), (d, COSINES))
    shifts = rng.uniform(0, 2 * np.pi, COSINES)
    none = np.zeros(0)
    start = QualityModel(mean, scale, turns, shifts, none, none, none)

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = start.cosines(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums, k = _summed(rows, equations), COSINES + 1
    weights = np.linalg.solve(sums[: k * k].reshape(k, k) + RIDGE * n / k * np.eye(k), sums[k * k :])
    ridge = dataclasses.replace(start, weights=weights)
    edges = np.linspace(-0.5, 1.5, BINS - 1)

    def count(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        raw = ridge.raw(x)
        at = np.searchsorted(edges, raw)
        return np.concatenate([np.bincount(at, v, BINS) for v in (np.ones(len(y)), y, raw)])

    n_bin, y_bin, raw_bin = _summed(rows, count).reshape(3, BINS)
    full = n_bin > 0
    steps = raw_bin[full] / n_bin[full]
    return dataclasses.replace(
        ridge, steps=steps, values=isotonic(steps, y_bin[full] / n_bin[full], n_bin[full])
    )


def training_labels(labels: DataFrame, column: str, folds: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, y) of the rows that may be learned from."""
    fold = crc_fold(F.col("doc_id"), folds)
    return labels.where(fold != held).select("doc_id", F.col(column).alias("y"))


def scored(stats: DataFrame, model: QualityModel, threshold: float = 0.5, folds: int = 3, held: int = 1) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. A null id is not held out."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch["stats"]) if len(batch) else np.zeros((0, len(NAMES)))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": model.score(x)})

    return stats.mapInPandas(score, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(crc_fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, model: QualityModel, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose text reaches the threshold. A row's text travels once, within the row."""
    ship(docs.sparkSession)
    rows, at = docs.select(F.struct(*columns_of(docs)).alias("doc")), docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.struct_field(batch.column(0), [at]).cast(pa.string())
            for start, end in cuts(texts, PIECE):
                found = [statistics(t) for t in texts.slice(start, end - start).to_pylist()]
                good = model.score(np.stack(found)) >= threshold
                if good.any():
                    yield batch.slice(start, end - start).filter(pa.array(good))

    return rows.mapInArrow(keep, rows.schema).select("doc.*")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = staged(measured(table(spark, sf_dir, "documents")), "statistics")
    labels = training_labels(table(spark, sf_dir, "labels"), "quality")
    return scored(stats, fit(stats, labels))
