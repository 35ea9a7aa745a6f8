"""Approximate nearest neighbours by cosine: a hierarchical k-means tree, searched best bin first.

Equal vectors collapse to one representative. The tree starts as one leaf. In each round, every leaf of more than twice `LEAF`
vectors is cut by spherical k-means, in a task of its own, fitted on about `SAMPLE` of its vectors (those with the smallest hash of
their id); all vectors are then counted down the tree again. Nodes stop being cut when their centres reach `TREE_BYTES`, which bounds the
broadcast tree; every vector is indexed in any case, and leaves of more than `BLOCK` vectors are searched block by block.

A query walks the tree through a priority queue that holds nodes by the cosine of their centre, so that it meets leaves best first, and
visits as many as the calibration asks for: of `PROBES` queries (smallest hash of the id) the nearest are found exactly, by comparison
with all vectors, and visits are widened until the share of these that lie in visited leaves reaches `RECALL`. Queries and the vectors
of the leaves they visit then meet in tasks by (leaf, block of vectors, block of queries) and are compared in double precision.

Vectors that are null, empty, zero, or hold null or non-finite components, and rows without an id, take no part. Vectors of different
length never meet; there may be as many lengths as centres fit in `TREE_BYTES`. Rows that repeat an id count once, with the vector whose hash is the smallest. An
empty table gives no rows. Ties go to the smaller id.
"""

from __future__ import annotations

import dataclasses
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.llm.embedding_dedup import usable, vector_type
from courtside.llm.tables import named, runs, ship, staged, table

LEAF = 1024
BRANCH = 16
SAMPLE = 4096
TREE_BYTES = 32 << 20
PROBES = 400
RECALL = 0.96
BLOCK = 2048
STEPS = 10
SEED = 13
SPREAD = np.uint64(0x9E3779B97F4A7C15)


# The tree -------------------------------------------------------------------------------------------------------


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors and their norms; very large and very small ones are scaled, so that no norm overflows or vanishes."""
    with np.errstate(over="ignore", under="ignore"):
        squares = np.einsum("ij,ij->i", vectors, vectors)
    odd = ~np.isfinite(squares) | (squares < 1e-250)
    if odd.any():
        vectors = vectors.copy()
        vectors[odd] /= np.abs(vectors[odd]).max(1, keepdims=True)
        squares[odd] = np.einsum("ij,ij->i", vectors[odd], vectors[odd])
    return vectors, np.sqrt(squares)


def units(vectors: np.ndarray) -> np.ndarray:
    x, norms = scaled(vectors)
    return (x / norms[:, None]).astype(np.float32)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    (x, a), (y, b) = scaled(x), scaled(y)
    return (x @ y.T) / (a[:, None] * b[None, :])


def kmeans(points: np.ndarray, branch: int, seed: int) -> np.ndarray:
    """Up to so many unit centres of unit points; one if the points are all alike."""
    rng = np.random.default_rng([SEED, seed])
    centres = points[rng.integers(len(points))][None]
    near = points @ centres[0]
    while len(centres) < branch:
        far = np.maximum(1 - near, 0) ** 2
        if far.sum() < 1e-9:
            break
        centres = np.vstack([centres, points[rng.choice(len(points), p=far / far.sum())]])
        near = np.maximum(near, points @ centres[-1])
    for _ in range(STEPS):
        own = (points @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        norms = np.linalg.norm(sums, axis=1)
        centres = sums[norms > 1e-6] / norms[norms > 1e-6, None]
        if not len(centres):
            return points[:1]
    return centres.astype(np.float32)


@dataclasses.dataclass(frozen=True)
class Tree:
    """Nodes with unit centres; the children of a node are `count` nodes from `first` on, a leaf has none."""

    centres: np.ndarray
    first: np.ndarray
    count: np.ndarray

    @classmethod
    def single(cls, size: int) -> Tree:
        return cls(np.zeros((1, size), np.float32), np.zeros(1, np.int64), np.zeros(1, np.int64))

    def cut(self, leaf: int, centres: np.ndarray) -> Tree:
        first, count = self.first.copy(), self.count.copy()
        first[leaf], count[leaf] = len(first), len(centres)
        none = np.zeros(len(centres), np.int64)
        return Tree(np.vstack([self.centres, centres]), np.concatenate([first, none]), np.concatenate([count, none]))

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each unit point, by its nearest child at every node."""
        at = np.zeros(len(points), np.int64)
        active = np.arange(len(points)) if self.count[0] else np.zeros(0, np.int64)
        while len(active):
            order = active[np.argsort(at[active], kind="stable")]
            cuts = np.flatnonzero(np.diff(at[order])) + 1
            for rows in np.split(order, cuts):
                node = at[rows[0]]
                children = slice(self.first[node], self.first[node] + self.count[node])
                at[rows] = self.first[node] + (points[rows] @ self.centres[children].T).argmax(1)
            active = order[self.count[at[order]] > 0]
        return at

    def best_first(self, point: np.ndarray) -> Iterator[int]:
        """The leaves, those of the nearest nodes first."""
        queue = [(-1.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.count[node]:
                yield node
                continue
            first = int(self.first[node])
            near = self.centres[first : first + self.count[node]] @ point
            for k, value in enumerate(near.tolist()):
                heapq.heappush(queue, (-value, first + k))


def by_size(vectors: pd.Series) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, vectors) of the vectors of each length."""
    lengths = np.fromiter(map(len, vectors), np.int64, len(vectors))
    for size in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == size)
        yield size, rows, np.stack(vectors.iloc[rows]).astype(np.float64)


# Growing it -----------------------------------------------------------------------------------------------------


def _counts(vectors: DataFrame, forest: dict[int, Tree]) -> dict[tuple[int, int], int]:
    """Vectors by (length, leaf); as many rows as leaves."""
    use = vectors.sparkSession.sparkContext.broadcast(forest)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, _, x in by_size(batch["vector"]):
                leaf, n = np.unique(use.value[size].leaf_of(units(x)), return_counts=True)
                yield pd.DataFrame({"size": size, "leaf": leaf, "n": n})

    found = vectors.select("vector").mapInPandas(count, "size long, leaf long, n long").groupBy("size", "leaf").agg(F.sum("n").alias("n"))
    return {(r["size"], r["leaf"]): r["n"] for r in found.collect()}


def _centres(vectors: DataFrame, forest: dict[int, Tree], full: dict[tuple[int, int], int], sample: int, leaf_rows: int):
    """(length, leaf, centres) of the leaves to cut."""
    use = vectors.sparkSession.sparkContext.broadcast((forest, full))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, full = use.value
        for batch in batches:
            mark = batch["mark"].to_numpy()
            for size, rows, x in by_size(batch["vector"]):
                points = units(x)
                leaf = forest[size].leaf_of(points)
                share = np.array([sample / full.get((size, k), np.inf) for k in leaf.tolist()])
                taken = np.flatnonzero(mark[rows] < share)
                if len(taken):
                    yield pd.DataFrame({"size": size, "leaf": leaf[taken], "mark": mark[rows][taken], "point": list(points[taken])})

    def cut(group: pd.DataFrame) -> pd.DataFrame:
        size, leaf = int(group["size"].iloc[0]), int(group["leaf"].iloc[0])
        points = np.stack(group.sort_values("mark")["point"]).astype(np.float32)
        branch = min(BRANCH, -(-use.value[1][size, leaf] // leaf_rows))
        found = kmeans(points, branch, leaf)
        return pd.DataFrame({"size": [size], "leaf": [leaf], "centres": [found.astype(np.float32).tobytes()]})

    mark = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "rep"), 11) / F.lit(float(1 << 53))).alias("mark")
    picked = vectors.select(mark, "vector").mapInPandas(pick, "size long, leaf long, mark double, point array<float>")
    return [
        (r["size"], r["leaf"], np.frombuffer(r["centres"], np.float32).reshape(-1, r["size"]))
        for r in picked.groupBy("size", "leaf").applyInPandas(cut, "size long, leaf long, centres binary").collect()
    ]


def grown(vectors: DataFrame, leaf_rows: int, sample: int) -> tuple[dict[int, Tree], dict[tuple[int, int], int]]:
    """The tree of each length, and the vectors of each leaf. Centres take TREE_BYTES at most."""
    sizes = vectors.groupBy(F.size("vector").alias("size")).count().limit(TREE_BYTES // 4 + 1).collect()
    if 4 * sum(r["size"] for r in sizes) > TREE_BYTES:
        raise ValueError("too many vectors' lengths for one tree each")
    forest = {r["size"]: Tree.single(r["size"]) for r in sizes}
    counts = {(r["size"], 0): r["count"] for r in sizes}
    final: set[tuple[int, int]] = set()
    while True:
        room = TREE_BYTES - sum(t.centres.nbytes for t in forest.values())
        full = {}
        for key, n in sorted(counts.items(), key=lambda item: (-item[1], item[0])):
            need = 4 * key[0] * BRANCH
            if n > 2 * leaf_rows and key not in final and need <= room:
                full[key] = n
                room -= need
        if not full:
            return forest, counts
        made = {(size, leaf): centres for size, leaf, centres in _centres(vectors, forest, full, sample, leaf_rows)}
        for key in sorted(full):
            if len(made.get(key, ())) > 1:
                forest[key[0]] = forest[key[0]].cut(key[1], made[key])
            else:
                final.add(key)
        counts = _counts(vectors, forest)


# Searching ------------------------------------------------------------------------------------------------------


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest of each row, ties to the smaller id."""
    if scores.shape[1] > 4 * k:
        cut = -np.partition(-scores, k - 1, 1)[:, k - 1]
        row, column = np.nonzero(scores >= cut[:, None])
    else:
        row, column = (v.ravel() for v in np.indices(scores.shape))
    order = np.lexsort((ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    start = np.searchsorted(row, row)
    keep = np.arange(len(row)) - start < k
    return row[keep], column[keep]


def _first(rows: DataFrame, keys: list[str], n: int, *order: Column | str) -> DataFrame:
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("at", at).where(F.col("at") <= n).drop("at")


def calibrated(vectors: DataFrame, forest: dict[int, Tree], k: int, probes: int, recall: float) -> int:
    """The leaf visits at which the probes' exact neighbours are found at this recall."""
    asked = vectors.where("query_id is not null").orderBy(F.xxhash64("rep"), "rep").limit(probes).collect()
    if not asked:
        return 1
    tables = {s: np.array([r["vector"] for r in asked if len(r["vector"]) == s]) for s in {len(r["vector"]) for r in asked}}
    numbers = {s: np.array([i for i, r in enumerate(asked) if len(r["vector"]) == s]) for s in tables}
    use = vectors.sparkSession.sparkContext.broadcast((forest, tables, numbers))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, tables, numbers = use.value
        for batch in batches:
            rep = batch["rep"].to_numpy(np.int64)
            for size, rows, x in by_size(batch["vector"]):
                if size in tables:
                    scores = cosines(tables[size], x)
                    probe, at = best(scores, rep[rows], k + 1)
                    leaf = forest[size].leaf_of(units(x))
                    ids = batch["ids"].iloc[rows[at]]
                    yield pd.DataFrame(
                        {"probe": numbers[size][probe], "score": scores[probe, at], "rep": rep[rows[at]], "leaf": leaf[at], "ids": list(ids)}
                    )

    found = vectors.select("rep", "vector", "ids").mapInPandas(
        search, "probe long, score double, rep long, leaf long, ids array<long>"
    )
    wanted: list[list[int]] = [[] for _ in asked]
    for r in sorted(_first(found, ["probe"], k + 1, F.desc("score"), "rep").collect(), key=lambda r: (-r["score"], r["rep"])):
        own = [i for i in r["ids"] if i != asked[r["probe"]]["query_id"]]
        wanted[r["probe"]] += [r["leaf"]] * len(own)
    wanted = [leaves[:k] for leaves in wanted]
    total, hit, visits = sum(map(len, wanted)), 0, 0
    walks = [forest[len(r["vector"])].best_first(units(np.array([r["vector"]]))[0]) for r in asked]
    while hit < recall * total:
        visits += 1
        for leaves, walk in zip(wanted, walks, strict=True):
            hit += leaves.count(next(walk, -1))
    return max(visits, 1)


def collapsed(vectors: DataFrame, id_col: str, vector_col: str, is_query: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (rep, vector, ids: the k + 1 smallest, query_id: the smallest query or null), and the queries (query_id, rep)."""
    rows = vectors.select(
        named(id_col).cast("long").alias("vec_id"), named(vector_col).cast(vector_type(vectors, vector_col)).alias("vector")
    )
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    plain = F.transform("vector", lambda x: x + F.lit(0.0))
    rows = rows.select("vec_id", "vector", F.xxhash64(plain).alias("h1"), F.xxhash64(F.lit(1), plain).alias("h2"))
    ids = rows.groupBy("vec_id").agg(F.min(F.struct("h1", "h2")).alias("h")).select("vec_id", "h.h1", "h.h2")
    ids = staged(ids, "ids")
    few = _first(ids, ["h1", "h2"], k + 1, "vec_id").groupBy("h1", "h2").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = ids.where(is_query).groupBy("h1", "h2").agg(F.min("vec_id").alias("query_id"))
    reps = few.join(asked, ["h1", "h2"], "left").withColumn("rep", F.col("ids")[0])
    keys = ["rep", "h1", "h2"]
    found = rows.withColumnRenamed("vec_id", "rep").join(reps, keys).dropDuplicates(keys)
    found = staged(found.select("rep", "vector", "ids", "query_id"), "vectors")
    queries = ids.where(is_query).join(reps.select("h1", "h2", "rep"), ["h1", "h2"]).select(F.col("vec_id").alias("query_id"), "rep")
    return found, queries


def nearest(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    is_query: str = "vec_id % 50 = 0",
    k: int = 5,
    leaf_rows: int = LEAF,
    sample: int = SAMPLE,
    probes: int = PROBES,
    recall: float = RECALL,
) -> DataFrame:
    """Per query and rank (from 1): query_id, rank, vec_id, score. `is_query` is a condition on vec_id, the id as a long."""
    spark = vectors.sparkSession
    ship(spark)
    found, queries = collapsed(vectors, id_col, vector_col, is_query, k)
    forest, counts = grown(found, leaf_rows, sample)
    visits = calibrated(found, forest, k, probes, recall)
    tree = spark.sparkContext.broadcast(forest)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, rows, x in by_size(batch["vector"]):
                walks = [tree.value[size].best_first(point) for point in units(x)]
                leaves = [[leaf for leaf, _ in zip(w, range(visits), strict=False)] for w in walks]
                yield pd.DataFrame({"rep": batch["rep"].to_numpy()[rows], "vector": list(x), "size": size, "leaves": leaves})

    asked = found.where("query_id is not null").select("rep", "vector")
    kind = vector_type(vectors, vector_col)
    asked = staged(asked.mapInPandas(walk, f"rep long, vector {kind}, size long, leaves array<long>"), "visits")
    visited = asked.select("size", F.explode("leaves").alias("leaf")).groupBy("size", "leaf").count()
    # Per leaf its blocks of vectors and of queries; as many entries as leaves.
    blocks = {
        (r["size"], r["leaf"]): (-(-counts.get((r["size"], r["leaf"]), 0) // BLOCK), -(-r["count"] // BLOCK)) for r in visited.collect()
    }
    blocks = {key: n for key, n in blocks.items() if n[0]}
    dealt = spark.sparkContext.broadcast(blocks)
    kinds = f"size long, leaf long, i long, j long, asks boolean, rep long, vector {kind}"

    def deal(batches: Iterator[pd.DataFrame], asks: bool) -> Iterator[pd.DataFrame]:
        """A row for every pair of blocks that the vector belongs to: i numbers blocks of vectors, j those of queries."""
        for batch in batches:
            rep = batch["rep"].to_numpy(np.int64)
            lot = ((rep.astype(np.uint64) * SPREAD) >> np.uint64(33)).astype(np.int64)
            for size, rows, x in by_size(batch["vector"]):
                places = batch["leaves"].iloc[rows] if asks else tree.value[size].leaf_of(units(x))[:, None]
                out = []
                for n, own in enumerate(places):
                    for leaf in own:
                        here, there = dealt.value.get((size, int(leaf)), (0, 0))
                        if here:
                            mine = int(lot[rows[n]]) % (there if asks else here)
                            out += [(n, leaf, *((other, mine) if asks else (mine, other))) for other in range(here if asks else there)]
                if out:
                    n, leaf, i, j = (np.array(v, np.int64) for v in zip(*out, strict=True))
                    yield pd.DataFrame(
                        {"size": size, "leaf": leaf, "i": i, "j": j, "asks": asks, "rep": rep[rows[n]], "vector": list(x[n])}
                    )

    sides = [
        found.select("rep", "vector").mapInPandas(lambda b: deal(b, False), kinds),
        asked.select("rep", "vector", "leaves").mapInPandas(lambda b: deal(b, True), kinds),
    ]
    keys = ["size", "leaf", "i", "j"]
    meeting = sides[0].unionByName(sides[1]).repartition(*keys).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, keys):
            asks = group["asks"].astype(bool)
            if asks.all() or not asks.any():
                continue
            x, rep = np.stack(group["vector"]).astype(np.float64), group["rep"].astype(np.int64)
            for part in np.array_split(np.flatnonzero(asks), int(asks.sum()) // 512 + 1):
                scores = cosines(x[part], x[~asks])
                row, column = best(scores, rep[~asks], k + 1)
                yield pd.DataFrame({"asked": rep[part[row]], "rep": rep[~asks][column], "score": scores[row, column]})

    near = meeting.mapInPandas(compare, "asked long, rep long, score double")
    near = staged(_first(near, ["asked"], k + 1, F.desc("score"), "rep"), "near")
    near = near.join(found.select("rep", "ids"), "rep").select("asked", "score", F.explode("ids").alias("vec_id"))
    near = _first(near, ["asked"], k + 1, F.desc("score"), "vec_id")
    answers = queries.join(near, F.col("rep") == F.col("asked")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
