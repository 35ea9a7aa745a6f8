"""Merkle manifest of a dataset: 8-ary hash trees in blocks of van Emde Boas layout.

Every row is a leaf, the SHA-256 of its framed columns. The leaves of each group (a language) form a tree in ascending id, and the groups'
roots form one more tree in the order of the groups. Runs of `FAN` nodes are hashed together, as lower-case hex text, while there is
more than one node.

Leaves are numbered by a range sort, whose partitions' row counts give each its first number. Aligned subtrees of `HEIGHT` levels of runs
are the blocks: each is built in one go by a task and stored as an array in van Emde Boas order, in which a tree is cut
at half its height and its upper part and its lower trees lie one after the other, each laid out the same way. Blocks' roots are the leaves of
further blocks, until a tree has one. Proofs go the other way: a block's own path to the root is joined to it once, and every leaf's
siblings are fetched from the block by address. No task holds more than `FAN ** HEIGHT` leaves and their block at a time.

Null columns are framed as `-`, so that null and empty differ; a null group is a group of its own, the first; null ids come first in a group. Rows
that repeat an id go by their digests, then by where they were read. A group of one row has its leaf as root. An empty table has no
leaves, and no root.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Iterator, Sequence
from functools import reduce
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.tables import named, numbered, runs, ship, staged, table

FAN = 8
HEIGHT = 4
DIGEST = 32
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def framed(values: Sequence[Column]) -> Column:
    """Byte count, colon and value of each, `-` for null."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def digest(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(framed(values), 256))


# Layout ---------------------------------------------------------------------------------------------------------


@functools.cache
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Where the nodes of a complete tree lie, by depth: the upper half of the levels first, then each tree below it."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    upper, lower = addresses(levels // 2), addresses(levels - levels // 2)
    first = sum(map(len, upper))
    starts = first + sum(map(len, lower)) * np.arange(FAN ** len(upper))
    return (*upper, *((starts[:, None] + own[None, :]).ravel() for own in lower))


def levels_above(n: int) -> int:
    """How often n nodes are gathered in runs until one is left."""
    height = 0
    while FAN**height < n:
        height += 1
    return height


def hashed(run: str) -> str:
    return sha256(run.encode()).hexdigest()


@dataclasses.dataclass(frozen=True)
class Block:
    """A subtree of up to FAN ** height leaves in van Emde Boas order."""

    height: int
    count: int
    nodes: np.ndarray

    @classmethod
    def build(cls, leaves: np.ndarray, height: int) -> Block:
        """leaves: rows of DIGEST bytes."""
        places = addresses(height + 1)
        nodes = np.zeros((sum(map(len, places)), DIGEST), np.uint8)
        nodes[places[height][: len(leaves)]] = leaves
        made = cls(height, len(leaves), nodes)
        for depth in range(height, 0, -1):
            above = [bytes.fromhex(hashed(run)) for run in made.runs(depth)]
            nodes[places[depth - 1][: len(above)]] = np.frombuffer(b"".join(above), np.uint8).reshape(-1, DIGEST)
        return made

    @classmethod
    def read(cls, height: int, count: int, raw: bytes) -> Block:
        return cls(height, count, np.frombuffer(raw, np.uint8).reshape(-1, DIGEST))

    def level(self, depth: int) -> str:
        """The digests of a depth as hex, one after the other."""
        n = -(-self.count // FAN ** (self.height - depth))
        return self.nodes[addresses(self.height + 1)[depth][:n]].tobytes().hex()

    def runs(self, depth: int) -> list[str]:
        whole, width = self.level(depth), 2 * DIGEST * FAN
        return [whole[at : at + width] for at in range(0, len(whole), width)]

    @property
    def root(self) -> bytes:
        return self.nodes[0].tobytes()

    def paths(self, above: str) -> list[str]:
        """Per leaf its path: by level from below the place in the run, the run's length and the siblings; `above` is the block's own."""
        found = [above]
        for depth in range(1, self.height + 1):
            found = [step + found[k] for k, run in enumerate(self.runs(depth)) for step in steps(run)]
        return found


def steps(run: str) -> list[str]:
    width = 2 * DIGEST
    size = len(run) // width
    return [f"{k}{size}{run[: k * width]}{run[(k + 1) * width :]}" for k in range(size)]


def parsed(path: str) -> Iterator[tuple[int, str]]:
    """(place in the run, siblings) by level."""
    at, width = 0, 2 * DIGEST
    while at < len(path):
        end = at + 2 + width * (int(path[at + 1]) - 1)
        yield int(path[at]), path[at + 2 : end]
        at = end


def folded(leaf: str, path: str) -> str:
    """The root that a leaf and its path lead to."""
    for place, siblings in parsed(path):
        cut = place * 2 * DIGEST
        leaf = hashed(siblings[:cut] + leaf + siblings[cut:])
    return leaf


def proof(path: str) -> str:
    """The siblings of a path, level by level, from left to right."""
    return "".join(siblings for _, siblings in parsed(path))


# Tables ---------------------------------------------------------------------------------------------------------


def _build(nodes: DataFrame, levels: int) -> DataFrame:
    """Blocks of so many levels of runs of nodes (tree, rank, n, leaf, and what goes along: id, known, claim)."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, ["tree", "block"]):
            n = int(group["n"][0])
            leaves = np.frombuffer(b"".join(group["leaf"]), np.uint8).reshape(-1, DIGEST)
            block = Block.build(leaves, min(levels, levels_above(n)))
            yield pd.DataFrame(
                {
                    "tree": [int(group["tree"][0])],
                    "block": [int(group["block"][0])],
                    "n": [n],
                    "height": [block.height],
                    "count": [block.count],
                    "nodes": [block.nodes.tobytes()],
                    "root": [block.root],
                    "ids": [group["id"].astype(np.int64).tobytes()],
                    "known": [group["known"].astype(bool).tobytes()],
                    "claims": [b"".join(group["claim"])],
                }
            )

    block = F.floor(F.col("rank") / FAN**levels).cast("long")
    dealt = nodes.withColumn("block", block).repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")
    return staged(
        dealt.mapInPandas(
            build,
            "tree long, block long, n long, height int, count int, nodes binary, root binary, ids binary, known binary, claims binary",
        ),
        "blocks",
    )


def _levels(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The blocks by level, from the nodes up to single blocks."""
    levels = [_build(nodes, height)]
    while not (above := levels[-1].where(f"n > {FAN**height}")).isEmpty():
        above = above.select(
            "tree", F.col("block").alias("rank"), F.ceil(F.col("n") / FAN**height).cast("long").alias("n"),
            F.col("root").alias("leaf"), F.lit(0).cast("long").alias("id"), F.lit(False).alias("known"), F.lit(b"").alias("claim"),
        )
        levels.append(_build(above, height))
    return levels


def _single(blocks: DataFrame, height: int) -> DataFrame:
    return blocks.where(f"n <= {FAN**height}")


def _tops(levels: list[DataFrame], height: int) -> DataFrame:
    """(tree, top): the root of each tree."""
    tops = [_single(blocks, height).select("tree", F.col("root").alias("top")) for blocks in levels]
    return reduce(DataFrame.unionByName, tops)


def _expanded(blocks: DataFrame, own: DataFrame, height: int) -> DataFrame:
    """(tree, block, path, subroot, root) of the blocks below, which are the leaves of these; `own` has the same of these."""

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                paths = Block.read(row.height, row.count_, row.nodes).paths(row.path)
                ranks = row.block * FAN**height + np.arange(len(paths))
                yield pd.DataFrame({"tree": row.tree, "block": ranks, "path": paths, "subroot": row.subroot, "root": row.top})

    rows = blocks.select("tree", "block", "height", F.col("count").alias("count_"), "nodes").join(
        own.withColumnRenamed("root", "top"), ["tree", "block"]
    )
    return rows.mapInPandas(expand, "tree long, block long, path string, subroot string, root string")


@dataclasses.dataclass(frozen=True)
class Manifest:
    """The blocks of the groups' trees and of the tree over them, by level, and the groups (group_value, tree, n)."""

    groups: DataFrame
    levels: list[DataFrame]
    over: list[DataFrame]
    height: int

    def roots(self) -> DataFrame:
        """group_value, n (leaves), subroot."""
        tops = _tops(self.levels, self.height).select("tree", F.hex("top").alias("subroot"))
        return self.groups.join(tops, "tree").select("group_value", "n", F.lower("subroot").alias("subroot"))

    def root(self) -> DataFrame:
        """One row with the root; none for an empty table."""
        return _tops(self.over, self.height).select(F.lower(F.hex("top")).alias("root"))

    def _paths(self) -> DataFrame:
        """(tree, block, path, subroot, root) of the blocks of leaves."""
        found = _single(self.over[-1], self.height).select(
            "tree", "block", F.lit("").alias("path"), F.lit("").alias("subroot"), F.lower(F.hex("root")).alias("root")
        )
        for blocks in reversed(self.over):
            found = _expanded(blocks, found, self.height)
        over = staged(found.select(F.col("block").alias("tree"), "path", "root"), "over")
        below = None
        for k in range(len(self.levels) - 1, -1, -1):
            blocks = self.levels[k]
            own = _single(blocks, self.height).select("tree", "block", F.lower(F.hex("root")).alias("subroot")).join(over, "tree")
            own = own.select("tree", "block", "path", "subroot", "root")
            own = own if below is None else own.unionByName(below)
            if not k:
                return own
            below = staged(_expanded(blocks, own, self.height), "paths")

    def audited(self) -> DataFrame:
        """Per leaf: id, leaf, subroot, root, proof_sha256, folded_root (from the claim and the leaf's siblings), verified."""

        def audit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples():
                    yield _audit(row)

        rows = self.levels[0].select("tree", "block", "height", F.col("count").alias("count_"), "nodes", "ids", "known", "claims").join(
            self._paths(), ["tree", "block"]
        )
        return rows.mapInPandas(
            audit,
            "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
        )


def _audit(row) -> pd.DataFrame:
    block, width = Block.read(row.height, row.count_, row.nodes), 2 * DIGEST
    inside, leaves, claims = block.paths(""), block.level(block.height), row.claims.hex()
    ends: dict[str, str] = {}
    out = []
    above = proof(row.path)
    for k, path in enumerate(inside):
        claim = folded(claims[k * width : (k + 1) * width], path)
        if claim not in ends:
            ends[claim] = folded(claim, row.path)
        out.append((leaves[k * width : (k + 1) * width], hashed(proof(path) + above), ends[claim]))
    found = pd.DataFrame(out, columns=["leaf", "proof_sha256", "folded_root"])
    ids = pd.array(np.frombuffer(row.ids, np.int64), "Int64")
    ids[~np.frombuffer(row.known, bool)] = pd.NA
    found["id"], found["subroot"], found["root"] = ids, row.subroot, row.root
    found["verified"] = found["folded_root"] == row.root
    return found[["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]]


def manifest(
    docs: DataFrame,
    *,
    columns: Sequence[str] = COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    claim: Sequence[Column] | None = None,
    height: int = HEIGHT,
) -> Manifest:
    """The manifest of the rows, each digested over `columns`.

    `claim`: the values that `audited` is to check against the manifest, in the order of `columns`; the rows' own by default.
    """
    ship(docs.sparkSession)
    own = [named(c) for c in columns]
    rows = docs.select(
        named(id_col).cast("long").alias("id"),
        named(group_col).cast("string").alias("group_value"),
        digest(own).alias("leaf"),
        (digest(claim) if claim else F.lit(None).cast("binary")).alias("claim"),
    )
    rows = staged(rows.withColumn("read", F.monotonically_increasing_id()), "leaves")
    placed, sizes = numbered(rows, ["group_value", "id", "leaf", "read"], ["group_value"])
    sizes = staged(sizes, "sizes")
    groups, parts = numbered(sizes.groupBy("group_value").agg(F.max("n").alias("n")), ["group_value"], [])
    parts = parts.select(F.col("part").alias("part_no"), "first", "before", F.col("n").alias("trees"))
    groups = groups.join(parts, F.shiftrightunsigned("seq", 33) == F.col("part_no")).select(
        "group_value", "n", (F.col("before") + F.col("seq") - F.col("first")).alias("tree"), "trees"
    )
    groups = staged(groups, "groups")
    known = groups.select(F.col("group_value").alias("of"), "tree")
    sizes = sizes.join(known, F.col("group_value").eqNullSafe(F.col("of"))).select("of", "tree", "part", "first", "before", "n")
    nodes = placed.join(
        sizes, F.col("group_value").eqNullSafe(F.col("of")) & (F.shiftrightunsigned("seq", 33) == F.col("part"))
    ).select(
        "tree", (F.col("before") + F.col("seq") - F.col("first")).alias("rank"), "n", "leaf", F.coalesce("id", F.lit(0)).alias("id"),
        F.col("id").isNotNull().alias("known"), F.coalesce("claim", "leaf").alias("claim"),
    )
    levels = _levels(nodes, height)
    over = _tops(levels, height).join(groups.select("tree", "trees"), "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.col("trees").alias("n"), F.col("top").alias("leaf"),
        F.lit(0).cast("long").alias("id"), F.lit(False).alias("known"), F.lit(b"").alias("claim"),
    )
    return Manifest(groups.select("group_value", "tree", "n"), levels, _levels(over, height), height)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 3 divides the id's checksum, the claimed text has A-Z in lower case."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claim = [*map(named, COLUMNS[:-1]), F.when(tampered, lower).otherwise(F.col("text"))]
    return manifest(docs, claim=claim).audited().withColumnRenamed("id", "doc_id")


_FRAMED = " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in COLUMNS[:-1])

ORACLE = f"""
WITH RECURSIVE rows AS (
    SELECT doc_id, lang, text, {_FRAMED} AS head, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, k: xor(v >> 1, (v & 1) * 3988292384))
    ) AS crc
    FROM documents
), leaves AS (
    SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
        sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS h,
        sha256(head || coalesce(strlen(text)::VARCHAR || ':' || CASE WHEN xor(crc, 4294967295) % 3 = 0
            THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS claim
    FROM rows
), nodes(lang, l, i, n, h) AS (
    SELECT lang, 0, i, n, h FROM leaves
    UNION ALL
    SELECT lang, l + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1
    GROUP BY lang, l, n, i // 8
), subroots AS (
    SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), over_nodes(l, i, n, h) AS (
    SELECT 0, i, n, h FROM subroots
    UNION ALL
    SELECT l + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM over_nodes WHERE n > 1 GROUP BY l, n, i // 8
), fold(doc_id, lang, l, i, n, h, proof) AS (
    SELECT doc_id, lang, 0, i, n, claim, '' FROM leaves
    UNION ALL
    SELECT f.doc_id, f.lang, f.l + 1, f.i // 8, (f.n + 7) // 8,
        sha256(string_agg(CASE WHEN s.i = f.i THEN f.h ELSE s.h END, '' ORDER BY s.i)),
        f.proof || coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i <> f.i), '')
    FROM fold f JOIN nodes s ON s.lang IS NOT DISTINCT FROM f.lang AND s.l = f.l AND s.i // 8 = f.i // 8
    WHERE f.n > 1 GROUP BY f.doc_id, f.lang, f.l, f.i, f.n, f.proof
), over_fold(doc_id, l, i, n, h, proof, subroot) AS (
    SELECT f.doc_id, 0, s.i, s.n, f.h, f.proof, s.h FROM fold f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1
    UNION ALL
    SELECT f.doc_id, f.l + 1, f.i // 8, (f.n + 7) // 8,
        sha256(string_agg(CASE WHEN s.i = f.i THEN f.h ELSE s.h END, '' ORDER BY s.i)),
        f.proof || coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i <> f.i), ''), f.subroot
    FROM over_fold f JOIN over_nodes s ON s.l = f.l AND s.i // 8 = f.i // 8
    WHERE f.n > 1 GROUP BY f.doc_id, f.l, f.i, f.n, f.proof, f.subroot
)
SELECT f.doc_id, v.h AS leaf, f.subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM over_fold f JOIN leaves v ON v.doc_id = f.doc_id JOIN over_nodes r ON r.n = 1 WHERE f.n = 1
"""
