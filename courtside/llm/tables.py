"""Written intermediate tables, connected components and the folds of the labelled rows."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.session import discard, scratch_folder


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, as on one machine or a shared
    drive; elsewhere install it on the executors or give it with --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(column: str) -> Column:
    """The column of exactly this name, whatever characters are in it."""
    return F.col("`" + column.replace("`", "``") + "`")


def columns_of(df: DataFrame) -> list[Column]:
    return [named(c) for c in df.columns]


def staged(df: DataFrame, purpose: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """The rows written to the shared folder and read again: a cut in the lineage that survives lost executors."""
    return _staged_at(df, purpose, partition_by)[0]


def _staged_at(df: DataFrame, purpose: str, partition_by: Iterable[str] = ()) -> tuple[DataFrame, str]:
    path = scratch_folder(df.sparkSession, purpose)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Dealt by the keys to as many tasks as the session's shuffles have: for work that costs much more than
    its bytes show, which adaptive execution would gather in a few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def runs(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The groups of rows that come sorted by the (non-null, whole-number) keys, each as arrays by column.

    A group may go over the ends of batches; one group is held at a time.
    """
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        if not len(batch):
            continue
        rows = {c: batch[c].to_numpy() for c in batch.columns}
        new = np.zeros(len(batch), bool)
        for k in keys:
            new[1:] |= rows[k][1:] != rows[k][:-1]
        cuts = [0, *np.flatnonzero(new), len(batch)]
        for i, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
            part = {c: v[start:end] for c, v in rows.items()}
            if held and (i or any(held[0][k][0] != part[k][0] for k in keys)):
                yield _joined(held)
                held = []
            held.append(part)
    if held:
        yield _joined(held)


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def numbered(rows: DataFrame, order: Sequence[str | Column], group: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows in a global order with `seq`, and per group and part of the order: first seq, rows before it in the group, rows of the group.

    A row's number in its group is before + seq - first. The second table has a row for each part and at most one more for each group.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(placed.withColumn("seq", F.monotonically_increasing_id()), "ordered")
    sizes = placed.groupBy(*group, F.shiftrightunsigned("seq", 33).alias("part")).agg(
        F.count("*").alias("rows"), F.min("seq").alias("first")
    )
    by_part = Window.partitionBy(*group).orderBy("part")
    return placed, sizes.select(
        *group,
        "part",
        "first",
        (F.sum("rows").over(by_part) - F.col("rows")).alias("before"),
        F.sum("rows").over(Window.partitionBy(*group)).alias("n"),
    )


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); the component is its smallest node.

    Large-star and small-star steps take turns until the edges no longer change. Each step is an
    aggregation to the smallest neighbour and an equi-join with it, so the neighbours of a node never
    meet in one task. Edges are written once a round, and those of the round before are deleted. Null ends and loops are ignored.
    """
    now, path = _staged_at(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen = _digest(now)
    while True:
        new, new_path = _staged_at(_small_star(_large_star(now)), "edges")
        discard(edges.sparkSession, path)
        now, path, before = new, new_path, seen
        seen = _digest(now)
        if seen == before:
            break
    centres = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour (or to itself)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    near = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
