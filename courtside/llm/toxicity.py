"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posteriors.

Every voter looks at a whole text and votes or abstains: one for each term of the lexicons, patterns (masked
spelling, address followed by an insult, shouting, runs of exclamation marks, and the absence of all insults), and voters induced from
the given labels: words and beginnings of words that toxic training texts hold far more often than the others, up to `INDUCED` of them.
A voter that abstains says nothing. The label model takes each
voter's chance of voting on toxic and on other texts and the prior, and estimates them by expectation maximisation over the
counts of vote patterns; given labels of the training folds are one more voter, of fixed reliability `GIVEN`. Pairs of voters whose votes go together more than the model explains are correlated;
a voter's evidence is divided by one plus its correlations, so that voters that say the same thing count once.

The posteriors of a bounded sample of training rows, given labels included, are the soft labels of a logistic classifier over hashed words,
their beginnings and votes: at most `PER_SIDE` rows on either side of one half, those with the smallest hash of their id. Each weighs as many rows
as it stands for, so that the two sides have their shares of the training folds at every size. Vote statistics
are over all rows of the training folds; voters are induced from at most `PER_SIDE` rows of each label, chosen the same way.

Null and empty texts have no votes and no words and get the score of the intercept. An empty table gives no rows. Without any training row
there is nothing to learn, and every score is 0; without labels no voters are induced. Rows that
repeat an id are scored each by its own text. Labels that are null are as good as no labels.
"""

from __future__ import annotations

import dataclasses
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.plaintext import parts
from courtside.llm.tables import crc_fold, ship, staged, table

# Insults by language.
LEXICON = {
    "en": "idiot moron stupid trash pathetic worthless scum loser disgusting clown dumb garbage imbecile fool jerk vermin filth "
    "ugly freak bastard bitch asshole retard coward parasite",
    "de": "dummkopf abschaum trottel versager widerlich erbärmlich wertlos schwachkopf vollidiot arschloch drecksack",
    "fr": "imbécile crétin abruti connard salaud ordure minable débile dégoûtant nul",
    "es": "imbécil estúpido basura inútil escoria perdedor patético asqueroso cabrón payaso",
}
TERMS = sorted({w for words in LEXICON.values() for w in words.split()})
PATTERNS = ("masked", "address", "shouting", "exclaiming", "silent")
FIXED = (*TERMS, *PATTERNS)

#: Chances of label 1 on other and on toxic texts.
GIVEN = (0.02, 0.9)
HASHED = 1 << 17
PER_SIDE = 2500
ROUNDS = 25
STEPS = 150
#: Lengths of the beginnings of words, and what an induced voter needs: toxic texts that hold it, and how many times their share that of others.
BEGINNINGS = (4, 6)
INDUCED, SUPPORT, RATIO = 200, 4, 20.0
CACHED_WORDS = 300_000
FLOOR = 1e-4
SEED = 3

_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"\b\w*[0-9@$!*]\w*[\w]")
_PLAIN = str.maketrans("013457@$!*", "oieastasi ")
_ADDRESS = re.compile(r"\byou(?:'re| are)?(?: such)?(?: an?| the)? (\w+)")
_TERM_SET = frozenset(TERMS)
_ENDS = ".,;:!?\"'()[]-…«»„“”"
_NOT_UPPER = bytes(k for k in range(256) if not 65 <= k <= 90)
_NOT_LOWER = bytes(k for k in range(256) if not 97 <= k <= 122)
_NOT_ASCII = bytes(range(128, 256))


def pieces_of(word: str) -> list[str]:
    """The word, and its beginnings, which end in a mark."""
    n = len(word)
    return [word, *[word[:k] + "*" for k in BEGINNINGS if n > k]]


class _Kept(dict):
    """Values by word, made when first asked for; bounded."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, word: str):
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = self.make(word)
        return value


def _column(piece: str) -> int:
    return xxhash.xxh3_64_intdigest(piece) % HASHED


def _columns(word: str) -> list[int]:
    return [_column(piece) for piece in pieces_of(word)]


class _Tokens(_Kept):
    """By stretch without white space: its words, and whether it is a masked insult."""

    def __init__(self):
        super().__init__(self._token)

    @staticmethod
    def _token(token: str) -> tuple[tuple[str, ...], bool]:
        core = token.strip(_ENDS)
        if core.isalpha():  # one word, and nothing masked in it
            return (core,), False
        masked = any(m.translate(_PLAIN).replace(" ", "") in _TERM_SET for m in _MASKED.findall(token))
        return tuple(set(_WORD.findall(token))), masked

    def words(self, low: str) -> tuple[set[str], bool]:
        found = set(map(self.__getitem__, set(low.split())))
        return {word for own, _ in found for word in own}, any([odd for _, odd in found])


class Voters:
    """The fixed voters and the induced ones, which are pieces of words."""

    def __init__(self, induced: tuple[str, ...] = ()):
        self.names = (*FIXED, *induced)
        self.place = {name: k for k, name in enumerate(self.names)}
        self.of_piece = {piece: len(FIXED) + k for k, piece in enumerate(induced)}
        self._make_cache()

    def _make_cache(self) -> None:
        self.of_word = _Kept(self._of_word)

    def _of_word(self, word: str) -> tuple[int, ...]:
        return self.of_pieces(pieces_of(word))

    def of_pieces(self, pieces: list[str]) -> tuple[int, ...]:
        """The voters of a word, given its pieces."""
        cast = [self.of_piece[p] for p in pieces if p in self.of_piece]
        return (self.place[pieces[0]], *cast) if pieces[0] in _TERM_SET else tuple(cast)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "of_word"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._make_cache()

    def votes(self, text: str, low: str, found: set[int], masked: bool) -> list[int]:
        """The voters that speak up: those found in the words, and the patterns; `silent` does where no insult was found."""
        if masked:
            found.add(self.place["masked"])
        if "you" in low and any(w in _TERM_SET for w in _ADDRESS.findall(low)):
            found.add(self.place["address"])
        if not found:
            found.add(self.place["silent"])
        if shouts(text):
            found.add(self.place["shouting"])
        if low.count("!") * 50 > len(low):
            found.add(self.place["exclaiming"])
        return sorted(found)

    def read(self, text: str, tokens: _Tokens) -> tuple[list[int], set[str]]:
        """The votes and the lower-case words of a text."""
        low = text.lower()
        words, masked = tokens.words(low)
        found: set[int] = set()
        for word in words:
            if cast := self.of_word[word]:
                found.update(cast)
        return self.votes(text, low, found, masked), words


def shouts(text: str) -> bool:
    """More than 20 capital letters, and more than half of the letters; most texts are told by their ASCII letters alone."""
    raw = text.encode("utf-8", "surrogatepass")
    upper, lower, plain = (len(raw.translate(None, rest)) for rest in (_NOT_UPPER, _NOT_LOWER, _NOT_ASCII))
    other = len(text) - plain
    if upper + other <= 20 or 2 * (upper + other) <= upper + lower:
        return False
    capitals = sum(map(str.isupper, text))
    return capitals > 20 and 2 * capitals > sum(map(str.isalpha, text))


def induced(docs: DataFrame, labels: DataFrame, per_side: int = PER_SIDE) -> Voters:
    """The voters, with those that labelled texts teach; docs: doc_id, text; labels: doc_id, y."""
    mark = F.xxhash64("doc_id")
    sides = [labels.where(F.col("y") == y).orderBy(mark, "doc_id").limit(per_side) for y in (1, 0)]
    chosen = staged(sides[0].unionByName(sides[1]).select("doc_id", "y"), "labelled")
    totals = {r["y"]: r["n"] for r in chosen.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return Voters()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens()
        for batch in batches:
            for part, texts in parts(batch, 1_000_000):
                found: tuple[Counter, Counter] = (Counter(), Counter())
                for text, y in zip(texts, part.column(2).to_pylist(), strict=True):
                    found[y].update({piece for word in tokens.words(text.lower())[0] for piece in pieces_of(word)})
                names = sorted(found[0].keys() | found[1].keys())
                yield pa.RecordBatch.from_pydict(
                    {"piece": pa.array(names, pa.string()), "toxic": [found[1][n] for n in names], "other": [found[0][n] for n in names]}
                )

    texts = docs.join(chosen, "doc_id").select("doc_id", "text", F.col("y").cast("int").alias("y"))
    sums = texts.mapInArrow(count, "piece string, toxic long, other long").groupBy("piece").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")
    )
    share, rest = ((F.col(c) + 0.5) / (totals[y] + 1) for c, y in (("toxic", 1), ("other", 0)))
    best = sums.where(F.col("toxic") >= SUPPORT).withColumn("ratio", share / rest).where(F.col("ratio") >= RATIO)
    best = best.orderBy((F.col("toxic") * F.log("ratio")).desc(), "piece").limit(INDUCED)
    return Voters(tuple(r["piece"] for r in best.collect() if r["piece"] not in _TERM_SET))


def measured(docs: DataFrame, voters: Voters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and votes."""
    ship(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens()
        for batch in batches:
            for part, texts in parts(batch, 1_000_000):
                found = [voters.read(t, tokens)[0] for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "votes"]
                )

    return _texts(docs, id_col, text_col).mapInArrow(measure, "doc_id long, votes array<int>")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


@dataclasses.dataclass(frozen=True)
class LabelModel:
    """Chances of a vote on other and on toxic texts, chances of label 1 there, the prior, and each voter's weight."""

    chances: np.ndarray
    gold: np.ndarray
    prior: float
    weights: np.ndarray

    def log_odds(self, cast: np.ndarray, gold: np.ndarray | None = None) -> np.ndarray:
        """cast: rows of 0 and 1; gold: the given labels, -1 for none."""
        odds = np.log(self.prior / (1 - self.prior)) + cast @ (self.weights * np.log(self.chances[1] / self.chances[0]))
        if gold is not None:
            one, none = np.log(self.gold[1] / self.gold[0]), np.log((1 - self.gold[1]) / (1 - self.gold[0]))
            odds = odds + np.where(gold == 1, one, np.where(gold == 0, none, 0.0))
        return odds


def _matrix(lists: list, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    for k, at in enumerate(lists):
        out[k, list(at)] = 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def label_model(votes_and_labels: DataFrame, voters: Voters) -> LabelModel:
    """votes_and_labels: votes, y (0, 1 or null). Counts of equal rows are made once; each round sums over them in parts."""
    v = len(voters.names)
    patterns = staged(
        votes_and_labels.select("votes", F.coalesce(F.col("y").cast("int"), F.lit(-1)).alias("y"))
        .groupBy("votes", "y").agg(F.count("*").alias("n")),
        "votes",
    )
    start = np.vstack([np.full(v, 0.01), np.full(v, 0.2)])
    start[:, [voters.place["shouting"], voters.place["exclaiming"]]] = 0.05
    start[:, voters.place["silent"]] = 0.95, 0.2
    model = LabelModel(start, np.array(GIVEN), 0.1, np.ones(v))

    def totals(use: LabelModel, pairs: bool) -> np.ndarray:
        """Per side: rows, votes by voter; then, if asked for, votes by pairs of voters."""
        size = 2 * (v + 1) + 2 * v * v * pairs

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(size)
            for batch in batches:
                cast, y, n = _matrix(batch["votes"].tolist(), v), batch["y"].to_numpy(), batch["n"].to_numpy()
                p = _sigmoid(use.log_odds(cast, y))
                sides, joint = [], []
                for share in ((1 - p) * n, p * n):
                    sides.append(np.concatenate([[share.sum()], share @ cast]))
                    if pairs:
                        joint.append(((cast * share[:, None]).T @ cast).ravel())
                total += np.concatenate([*sides, *joint])
            yield pd.DataFrame({"total": [total.tobytes()]})

        rows = patterns.mapInPandas(add, "total binary").collect()
        return np.sum([np.frombuffer(r.total) for r in rows], axis=0) if rows else np.zeros(size)

    for k in range(ROUNDS):
        half = k == ROUNDS // 2
        sums = totals(model, half)
        sides = sums[: 2 * (v + 1)].reshape(2, v + 1)
        n = sides[:, :1]
        if not n.sum():
            return model
        chances = np.clip((sides[:, 1:] + [[0.001], [0.01]]) / (n + 1), FLOOR, 1 - FLOOR)
        weights = model.weights
        if half:
            weights = 1 / (1 + _correlations(sums[2 * (v + 1) :].reshape(2, v, v), chances, n.ravel()))
        new = LabelModel(chances, model.gold, float(np.clip(n[1, 0] / n.sum(), 0.001, 0.5)), weights)
        settled = np.abs(new.chances - model.chances).max() < 1e-4
        model = new
        if settled and k > ROUNDS // 2:
            break
    return model


def _correlations(pairs: np.ndarray, chances: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per voter the sum of its positive correlations with the others that the sides don't explain."""
    total = np.zeros(pairs.shape[1:])
    for side in (0, 1):
        joint, p = pairs[side] / max(n[side], 1.0), chances[side]
        spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
        total += (joint - np.outer(p, p)) / spread * n[side] / n.sum()
    np.fill_diagonal(total, 0)
    return np.where(total > 0.1, total, 0).sum(1)


@dataclasses.dataclass(frozen=True)
class ToxicityModel:
    voters: Voters
    words: np.ndarray
    votes: np.ndarray
    bias: float

    def scorer(self):
        """Scores texts; keeps the weights of the words it has met."""

        weights = self.words.tolist()

        def weigh(word: str) -> tuple[float, int, tuple[int, ...]]:
            pieces = pieces_of(word)
            return sum([weights[_column(p)] for p in pieces]), len(pieces), self.voters.of_pieces(pieces)

        kept, tokens = _Kept(weigh), _Tokens()

        def score(texts: list[str]) -> np.ndarray:
            raw = np.empty(len(texts))
            for k, text in enumerate(texts):
                low, total, count = text.lower(), 0.0, 0
                words, masked = tokens.words(low)
                found: set[int] = set()
                for word in words:
                    value, n, cast = kept[word]
                    total += value
                    count += n
                    if cast:
                        found.update(cast)
                cast = self.voters.votes(text, low, found, masked)
                raw[k] = self.bias + self.votes[cast].sum() + (total / count**0.5 if count else 0.0)
            return np.where(np.isneginf(raw), 0.0, _sigmoid(raw))

        return score


def train(
    found: list[tuple[list[int], list[int]]], target: np.ndarray, voters: Voters, weight: np.ndarray | None = None
) -> ToxicityModel:
    """Logistic regression on soft labels by Adam, with shrinkage that is stronger for words than for votes.

    found: votes and columns of each row; weight: how many rows each stands for, one if not given. Without rows every score is 0.
    """
    v = len(voters.names)
    if not found:
        return ToxicityModel(voters, np.zeros(HASHED), np.zeros(v), -np.inf)
    weight = np.ones(len(found)) if weight is None else weight
    share = weight / weight.sum()
    counts = np.array([len(at) for _, at in found])
    rows = np.repeat(np.arange(len(found)), counts)
    columns = np.concatenate([np.asarray(at, np.int64) for _, at in found])
    used, columns = np.unique(columns, return_inverse=True)
    values = np.repeat(1 / np.sqrt(np.maximum(1, counts)), counts)
    cast = _matrix([c for c, _ in found], v)
    h = len(used)
    p = np.zeros(h + v + 1)
    shrink = np.concatenate([np.full(h, 1e-3), np.full(v, 1e-5), [0.0]])
    first, second = np.zeros_like(p), np.zeros_like(p)
    for k in range(1, STEPS + 1):
        raw = np.bincount(rows, values * p[columns], len(found)) + cast @ p[h:-1] + p[-1]
        slope = (_sigmoid(raw) - target) * share
        g = np.concatenate([np.bincount(columns, values * slope[rows], h), slope @ cast, [slope.sum()]]) + shrink * p
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        p -= 0.1 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
    words = np.zeros(HASHED)
    words[used] = p[:h]
    return ToxicityModel(voters, words, p[h:-1], float(p[-1]))


def fit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", per_side: int = PER_SIDE
) -> ToxicityModel:
    """docs: rows of the training folds; labels: doc_id, y, of which those of other folds are left out already."""
    texts = _texts(docs, id_col, text_col).where("doc_id is not null")
    given = staged(labels.where("y is not null").groupBy("doc_id").agg(F.max("y").alias("y")), "given")
    voters = induced(texts, given, per_side)
    cast = staged(measured(docs, voters, id_col, text_col), "votes")
    both = staged(cast.join(given, "doc_id", "left").select("doc_id", "votes", F.coalesce(F.col("y").cast("int"), F.lit(-1)).alias("y")), "both")
    model = label_model(both.select("votes", F.when(F.col("y") >= 0, F.col("y")).alias("y")), voters)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cast = _matrix(batch["votes"].tolist(), len(voters.names))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "p": _sigmoid(model.log_odds(cast, batch["y"].to_numpy()))})

    judged = staged(
        both.where("doc_id is not null").mapInPandas(judge, "doc_id long, p double")
        .withColumn("mark", F.xxhash64("doc_id")), "posteriors",
    )
    chosen = judged.where("p >= 0.5").orderBy("mark", "doc_id").limit(per_side).unionByName(
        judged.where("p < 0.5").orderBy("mark", "doc_id").limit(per_side)
    )
    soft = {r["doc_id"]: r["p"] for r in chosen.collect()}
    sides = {r["toxic"]: r["n"] for r in judged.groupBy((F.col("p") >= 0.5).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    ids = docs.sparkSession.createDataFrame([(i,) for i in soft] or [(None,)], "doc_id long")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, tokens = _Kept(_columns), _Tokens()
        for batch in batches:
            for part, own in parts(batch, 1_000_000):
                seen = [voters.read(t, tokens) for t in own]
                found = [np.array(sorted(c for w in ws for c in columns[w]), np.int32) for _, ws in seen]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([cast for cast, _ in seen], pa.list_(pa.int32())),
                        pa.array([at.tobytes() for at in found], pa.binary()),
                    ],
                    names=["doc_id", "votes", "words"],
                )

    sample = texts.join(F.broadcast(ids), "doc_id").mapInArrow(describe, "doc_id long, votes array<int>, words binary").collect()
    sample = {r["doc_id"]: r for r in sorted(sample, key=lambda r: (r["doc_id"], r["votes"], r["words"]))}
    use = [sample[i] for i in sorted(sample)]
    target = np.array([soft[r["doc_id"]] for r in use])
    toxic = target >= 0.5
    stands_for = {side: sides.get(side, 0) / max(1, int((toxic == side).sum())) for side in (True, False)}
    found = [(r["votes"], np.frombuffer(r["words"], np.int32)) for r in use]
    return train(found, target, voters, np.where(toxic, stands_for[True], stands_for[False]))


def scored(
    docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = 0.7, folds: int = 3, held: int = 1,
) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. A null id is not held out."""
    ship(docs.sparkSession)
    use = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = use.value.scorer()
        for batch in batches:
            for part, texts in parts(batch, 1_000_000):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scorer(texts))], names=["doc_id", "score"])

    return _texts(docs, id_col, text_col).mapInArrow(score, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(crc_fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    fold = crc_fold(F.col("doc_id"), 3)
    learn = labels.where(fold != 1).select("doc_id", F.col("toxic").alias("y"))
    return scored(docs, fit(docs.where(fold != 1), learn))
