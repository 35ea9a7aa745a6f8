"""Embedding near-dedup: random-hyperplane sign hashing, exact cosine verification, distributed components.

Equal vectors collapse to one representative with a count. Each representative gets, in every table, the signs of its
products with random hyperplanes as a code; those that share a code in a table meet there. Their cosines are
computed in double precision, and a pair is counted in the first table in which it meets. Codes of many
vectors are cut into blocks of about `BLOCK`, and pairs of blocks are compared in tasks of their own,
which return counts and a spanning forest of the links, never the pairs.

The number of bits grows with the logarithm of the number of vectors, so that codes hold a few dozen vectors each
unless these are alike; the number of tables follows from the bits, such that a pair at the threshold is found with
probability `recall`, and a closer pair more surely.

Vectors that are null, empty, zero, or hold null or non-finite components, and rows without an id, link with
nothing. Vectors of different length do not meet. Rows that repeat an id are one node. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.tables import components, named, runs, ship, spread, staged, table

BLOCK = 1024
A_CODE = 48
SEED = 11


def plan(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits, tables): codes of about A_CODE vectors, and as many tables as the recall asks for."""
    bits = max(8, math.ceil(math.log2(max(n, 1) / A_CODE)))
    same = (1 - math.acos(min(threshold, 1.0)) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def vector_type(vectors: DataFrame, vector_col: str) -> str:
    """The type that vectors are moved in: single precision if they are stored so, which loses nothing, else double."""
    kind = vectors.select(named(vector_col).alias("v")).schema["v"].dataType.simpleString()
    return "array<float>" if kind == "array<float>" else "array<double>"


def usable(vector: Column) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def signs(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The code of each vector in each table; the hyperplanes depend on the length of the vectors alone."""
    rng = np.random.default_rng([SEED, vectors.shape[1]])
    planes = rng.standard_normal((vectors.shape[1], tables * bits))
    flags = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return flags @ (1 << np.arange(bits, dtype=np.int64))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index of each one's component under the links (a, b) over 0..n-1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compared(group: dict[str, np.ndarray], threshold: float) -> pd.DataFrame:
    """Links between blocks i and j of a code: per representative its copies' links, and an edge of the forest."""
    ids, copies, block = (group[c].astype(np.int64) for c in ("rep", "copies", "block"))
    codes, no = np.stack(group["codes"]), int(group["no"][0])
    x = np.stack(group["vector"]).astype(np.float64)
    norms = np.sqrt((x * x).sum(1))
    left, right = (np.flatnonzero(block == group[side][0]) for side in ("i", "j"))
    links, edges = np.zeros(len(ids), np.int64), []
    for part in np.array_split(left, max(1, len(left) // 256)):
        if not len(part) or not len(right):
            continue
        cosine = (x[part] @ x[right].T) / (norms[part][:, None] * norms[right][None, :])
        i, j = np.nonzero(cosine >= threshold)
        a, b = part[i], right[j]
        ok = ids[a] < ids[b] if group["i"][0] == group["j"][0] else ids[a] != ids[b]
        a, b = a[ok], b[ok]
        if no and len(a):
            fresh = ~(codes[a, :no] == codes[b, :no]).any(1)
            a, b = a[fresh], b[fresh]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        edges.append((a, b))
    a, b = (np.concatenate([e[k] for e in edges]) if edges else np.zeros(0, np.int64) for k in (0, 1))
    label = forest(a, b, len(ids))
    at = np.flatnonzero(links)
    return pd.DataFrame({"rep": ids[at], "links": links[at], "near": ids[label[at]]})


def near_duplicates(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.9,
    recall: float = 0.995,
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    ship(vectors.sparkSession)
    vector, kind = F.col("vector"), vector_type(vectors, vector_col)
    rows = vectors.select(
        named(id_col).cast("long").alias("vec_id"), named(vector_col).cast(kind).alias("vector")
    ).withColumn("ok", usable(vector) & F.col("vec_id").isNotNull())
    vector = F.transform("vector", lambda x: x + F.lit(0.0))
    rows = rows.select(
        "vec_id", "vector", F.when(F.col("ok"), F.xxhash64(vector)).alias("h1"),
        F.when(F.col("ok"), F.xxhash64(F.lit(1), vector)).alias("h2"),
    )
    reps = rows.where("h1 is not null").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")
    )
    reps = staged(reps, "vectors")
    bits, tables = plan(reps.count(), threshold, recall)
    narrow, code_type = next((n, t) for n, t in ((pa.int16(), "short"), (pa.int32(), "int"), (pa.int64(), "long")) if bits < n.bit_width)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list = [None] * batch.num_rows
            lists = batch.column(2)
            lengths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            for size in np.unique(lengths):
                at = np.flatnonzero(lengths == size)
                x = flat[starts[at][:, None] + np.arange(size)]
                for k, row in zip(at.tolist(), signs(x, bits, tables), strict=True):
                    found[k] = row
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(narrow))], names=["rep", "copies", "vector", "codes"]
            )

    coded = staged(
        reps.select("rep", "copies", "vector").mapInArrow(
            code, f"rep long, copies long, vector {kind}, codes array<{code_type}>"
        ),
        "codes",
    )
    places = coded.select("rep", F.size("vector").alias("size"), F.posexplode("codes").alias("no", "code"))
    counts = places.groupBy("size", "no", "code").agg(F.ceil(F.count("*") / BLOCK).alias("n"), F.count("*").alias("all"))
    own, n = F.col("block"), F.col("n")
    dealt = (
        places.join(counts.where("all > 1"), ["size", "no", "code"])
        .withColumn("block", F.pmod(F.xxhash64("rep"), n))
        .withColumn("pair", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")))))
        .select("size", "no", "code", "pair.i", "pair.j", "block", "rep")
        .join(coded, "rep")
    )
    keys = ["size", "no", "code", "i", "j"]
    dealt = spread(dealt, *keys).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, keys):
            yield compared(group, threshold)

    found = staged(dealt.mapInPandas(compare, "rep long, links long, near long"), "links")
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    edges = found.where("near <> rep").select(F.col("rep").alias("a"), F.col("near").alias("b")).distinct()
    parts = components(edges).withColumnRenamed("node", "rep")
    whole = reps.select("h1", "h2", "rep", "copies").join(linked, "rep", "left").join(parts, "rep", "left").select(
        "h1",
        "h2",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    return rows.select("vec_id", "h1", "h2").join(whole, ["h1", "h2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
