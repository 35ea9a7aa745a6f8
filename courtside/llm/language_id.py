"""Language ID: a byte convolutional network, trained in numpy and applied to windows of whole texts.

A window of `WINDOW` bytes is embedded byte by byte; filters of several widths slide over it, each filter's
largest response is kept, and a softmax layer gives the languages' probabilities. A text is cut into
windows from end to end; the mean of their log-probabilities, weighted by their letters, decides. For scoring the
trained filters are tabled over byte pairs, which gives the same responses with far fewer operations.

Training takes at most `PER_LANGUAGE` documents of each language, those with the smallest hash of their id, and
`WINDOWS` windows of each, spread evenly over the text; tasks cut them, and the driver gets these alone, some 200 KB a
language. Texts that are null or have no letter are `und` with score 0.
An empty table gives no rows; without a labelled document in the training folds every text is `und` with score 0.
Rows that repeat an id are judged each by its own text.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.llm.plaintext import parts
from courtside.llm.tables import crc_fold, named, ship, table

WINDOW = 128
WIDTHS = (2, 3, 4)
EMBED = 8
FILTERS = 8
PER_LANGUAGE = 400
WINDOWS = 4
EPOCHS = 12
BATCH = 64
RATE = 3e-3
SEED = 5
UNKNOWN = "und"


@dataclasses.dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    def tables(self) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Per width its responses by the first pair of bytes and by the rest, a byte or a pair."""
        out = []
        for f, b in zip(self.filters, self.biases, strict=True):
            single = np.einsum("be,wef->wbf", self.embedding, f).astype(np.float32)
            pair = (single[0][:, None] + single[1][None, :] + b).reshape(-1, f.shape[2])
            if len(f) == 2:
                out.append((pair, None))
            else:
                rest = single[2] if len(f) == 3 else (single[2][:, None] + single[3][None, :]).reshape(-1, f.shape[2])
                out.append((pair, rest))
        return out


def windows(raw: bytes) -> np.ndarray:
    """The text's bytes in rows of WINDOW, the last one filled up with zeros."""
    n = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, WINDOW)


class Scorer:
    """A trained network over tabled filters."""

    def __init__(self, model: LanguageModel):
        self.model, self.tabled = model, model.tables()

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Per window and language."""
        single = rows.astype(np.int32)
        pairs = single[:, :-1] * 256 + single[:, 1:]
        peaks = []
        for (pair, rest), width in zip(self.tabled, WIDTHS, strict=True):
            places = WINDOW - width + 1
            response = pair[pairs[:, :places]]
            if rest is not None:
                response += rest[single[:, 2:] if width == 3 else pairs[:, 2:]]
            peaks.append(response.max(1))
        hidden = np.maximum(np.hstack(peaks), 0)
        return _log_softmax(hidden @ self.model.weights + self.model.bias)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        known = [bool(self.model.languages) and any(map(str.isalpha, t)) for t in texts]
        cut = [windows(t.encode("utf-8", "surrogatepass")) if ok else None for t, ok in zip(texts, known, strict=True)]
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        at = [k for k, ok in enumerate(known) if ok]
        if not at:
            return names, scores
        rows = np.concatenate([cut[k] for k in at])
        found = np.concatenate([self.log_probabilities(rows[k : k + 512]) for k in range(0, len(rows), 512)])
        letters = (((rows | 32) >= 97) & ((rows | 32) <= 122) | (rows >= 128)).sum(1) + 1.0
        starts = np.cumsum([0, *[len(cut[k]) for k in at[:-1]]])
        mean = np.add.reduceat(found * letters[:, None], starts) / np.add.reduceat(letters, starts)[:, None]
        shares = np.exp(_log_softmax(mean))
        for k, best, share in zip(at, shares.argmax(1).tolist(), shares.max(1).tolist(), strict=True):
            names[k], scores[k] = self.model.languages[best], share
        return names, scores


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def sample(text: str) -> np.ndarray:
    """The windows of a text that are learned from."""
    own = windows(text.encode("utf-8", "surrogatepass"))
    return own[np.unique(np.linspace(0, len(own) - 1, WINDOWS).astype(int))]


def train(samples: list[np.ndarray], langs: list[str]) -> LanguageModel:
    """Adam on the cross-entropy of the windows. Without samples the network knows no language."""
    languages = sorted(set(langs))
    x = np.concatenate([np.zeros((0, WINDOW), np.uint8), *samples])
    y = np.array([languages.index(lang) for own, lang in zip(samples, langs, strict=True) for _ in own], np.int64)
    rng = np.random.default_rng(SEED)
    p = {"e": rng.normal(0, 0.3, (256, EMBED)), "w": rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(languages))), "b": np.zeros(len(languages))}
    for k in WIDTHS:
        p[f"f{k}"], p[f"c{k}"] = rng.normal(0, 1 / np.sqrt(k * EMBED), (k, EMBED, FILTERS)), np.zeros(FILTERS)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    share = np.bincount(y, minlength=len(languages)) / max(1, len(y))
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            take = order[at : at + BATCH]
            grads = _gradients(p, x[take], y[take], 1 / (len(languages) * share[y[take]]))
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return LanguageModel(languages, p["e"], [p[f"f{k}"] for k in WIDTHS], [p[f"c{k}"] for k in WIDTHS], p["w"], p["b"])


def _gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    n, embedded, kept, peaks = len(x), p["e"][x], {}, []
    for k in WIDTHS:
        slides = np.concatenate([embedded[:, j : WINDOW - k + 1 + j] for j in range(k)], 2)
        response = slides @ p[f"f{k}"].reshape(k * EMBED, FILTERS) + p[f"c{k}"]
        kept[k] = (slides, response.argmax(1))
        peaks.append(response.max(1))
    peak = np.hstack(peaks)
    hidden = np.maximum(peak, 0)
    out = np.exp(_log_softmax(hidden @ p["w"] + p["b"]))
    out[np.arange(n), y] -= 1
    out *= (weight / n)[:, None]
    grads = {"w": hidden.T @ out, "b": out.sum(0), "e": np.zeros_like(p["e"])}
    back = (out @ p["w"].T) * (peak > 0)
    for i, k in enumerate(WIDTHS):
        slides, best = kept[k]
        own = back[:, i * FILTERS : (i + 1) * FILTERS]
        taken = slides[np.arange(n)[:, None], best]
        grads[f"f{k}"] = np.einsum("nf,nfd->df", own, taken).reshape(k, EMBED, FILTERS)
        grads[f"c{k}"] = own.sum(0)
        for j in range(k):
            np.add.at(grads["e"], x[np.arange(n)[:, None], best + j], own[:, :, None] * p[f"f{k}"][j].T[None])
    return {k: v.astype(np.float32) for k, v in grads.items()}


def training_rows(
    docs: DataFrame, lang_col: str, per_language: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(lang, text) of at most so many rows of each language, those with the smallest hash of their id.

    The hash up to which a language's rows are taken is found on ids alone, in 64 parts of a language first; so
    neither a language nor the texts of the others are gathered.
    """
    rows = docs.select(
        named(id_col).alias("doc_id"), named(lang_col).cast("string").alias("lang"), named(text_col).cast("string").alias("text")
    )
    rows = rows.where(F.col("lang").isNotNull() & (F.trim("text") != "")).withColumn("mark", F.xxhash64("doc_id"))
    best = rows.select("lang", "mark", F.pmod("mark", F.lit(64)).alias("part"))
    for keys in (["lang", "part"], ["lang"]):
        best = _first(best, keys, per_language, "mark")
    ends = best.groupBy("lang").agg(F.max("mark").alias("end"))
    rows = rows.join(F.broadcast(ends), "lang").where("mark <= end")
    return _first(rows, ["lang"], per_language, "mark", "doc_id", "text").select("lang", "text")


def _first(rows: DataFrame, keys: list[str], n: int, *order: str) -> DataFrame:
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("at", at).where(F.col("at") <= n).drop("at")


def fit(
    docs: DataFrame, *, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", per_language: int = PER_LANGUAGE
) -> LanguageModel:
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts(batch, 500_000):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([sample(t).tobytes() for t in texts], pa.binary())], names=["lang", "windows"]
                )

    rows = training_rows(docs, lang_col, per_language, id_col, text_col).mapInArrow(cut, "lang string, windows binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["windows"])))
    return train([np.frombuffer(r["windows"], np.uint8).reshape(-1, WINDOW) for r in rows], [r["lang"] for r in rows])


def predicted(
    docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, held: int = 2
) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score. A null id is not held out."""
    ship(docs.sparkSession)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for part, texts in parts(batch, 500_000):
                names, scores = scorer.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    rows = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double").select(
        "doc_id",
        F.coalesce(crc_fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predicted(docs, fit(docs.where(crc_fold(F.col("doc_id"), 4) != 2)))
