"""N-gram Jaccard join: signature trees over groups of documents that share a rare shingle.

A document is the set of its distinct word n-grams; two link when their Jaccard similarity reaches a
percentage. The join is exact (up to equal 64-bit hashes of different shingles):

1. Equal sets collapse to one representative, the smallest id.
2. Shingles are ordered by how common they are, then by hash. Two linked sets share a shingle among the
   first `n - ceil(t n) + 1` of each, so representatives that share such a shingle (and a size class) form
   a group. Commonness comes from a sketch of all shingles; it only orders them, so its errors cost time,
   never links. Passages that many documents share thus fall out of the groups.
3. Each group is cut into blocks, and the group's smallest member goes to all of them. A block's members, in the order of their sizes,
   are the leaves of a signature tree (nodes with OR-combined token bitmaps, size ranges and component ranges), which is traversed
   against itself, dropping node pairs whose largest possible overlap is below what their sizes ask for. The pairs of leaves that remain are
   candidates. A crowded block gives one for each member only: the smallest member of the group if the traversal reached it, else the
   first one. Verified, the candidates give components.
4. Groups of several blocks and crowded ones that still hold several components are traversed again, by pairs of blocks from both sides,
   now dropping node pairs of one component too; all that is left is a candidate.
5. All candidate pairs are verified on the full sets, those of crowded blocks within the block; components follow from
   the links.

No group is gathered whole: blocks hold about `BLOCK` members, and only blocks that can hold two
components meet. Rows without text or words have no shingles and link with nothing. Rows that share an id
are one node; rows without an id keep their count and get no component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.plaintext import cuts, parts
from courtside.llm.tables import components, runs, spread, staged, table

BUCKETS = 1 << 17
BLOCK = 2048
PIECE_WORDS = 1 << 20
FAN = 8
CANDIDATES = 4
CACHED_WORDS = 100_000
#: Batches are worked on in pieces of so many bytes of text or of sets, or of a single row.
PIECE_BYTES = 2_000_000

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


CLASS_MARKS = _mixed(np.arange(1, 66, dtype=np.uint64) * _MIX[0])


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, words: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; ASCII letters fold, ASCII white space separates."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    width = min(words, len(found))
    last = len(found) - width + 1
    value = np.full(last, width, np.uint64)
    for k in range(width):
        value = _mixed(value * _MIX[0] + codes[k : k + last])
    return np.unique(value)


def size_class(n: int) -> int:
    return n.bit_length() - 1


def signature(tokens: np.ndarray, kind: int) -> np.ndarray:
    """Bitmap of a set of a size class: two to four bits a token."""
    bits = 1 << max(6, kind + 2)
    flags = np.zeros(bits, bool)
    flags[(tokens >> np.uint64(20)) & np.uint64(bits - 1)] = True
    return np.packbits(flags, bitorder="little")


def fitted(sigs: list[bytes]) -> np.ndarray:
    """The bitmaps folded to the width of the narrowest, as rows of 64-bit words."""
    wide, out = min(map(len, sigs)), []
    for raw in sigs:
        sig = np.frombuffer(raw, np.uint8)
        while len(sig) > wide:
            sig = sig[: len(sig) // 2] | sig[len(sig) // 2 :]
        out.append(sig)
    return np.stack(out).view(np.uint64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def commonness(texts: DataFrame, words: int) -> np.ndarray:
    """Per bucket of shingles, the doublings by which its count passes the mean; BUCKETS bytes in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = _WordHashes(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, own in parts(batch, PIECE_BYTES):
                for text in own:
                    np.add.at(total, (shingle_set(text, words, hashes) & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BUCKETS)
    counts[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    return np.floor(np.log2(np.maximum(counts / max(counts.mean(), 1.0), 1.0))).astype(np.uint8)


def prefix(tokens: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of which two linked sets share one: rare ones first, then by hash."""
    if not len(tokens):
        return tokens
    length = len(tokens) - (percent * len(tokens) + 99) // 100 + 1
    rank = common[(tokens & np.uint64(BUCKETS - 1)).astype(np.int64)]
    return tokens[np.lexsort((tokens, rank))[:length]]


def described(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Per row: doc_id, n_shingles, set_key (a digest of the set), sig, and the keys under which it is grouped.

    A set near the upper end of its size class is also grouped in the next class, so that all sets that
    can link meet in one of them.
    """
    common = texts.sparkSession.sparkContext.broadcast(commonness(texts, words))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            yield from description(batch, words, percent, common.value, hashes)

    return texts.mapInArrow(describe, "doc_id long, n_shingles long, set_key string, sig binary, keys array<long>")


def description(
    batch: pa.RecordBatch, words: int, percent: int, common: np.ndarray, hashes: dict[bytes, int], size: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """What `described` gives for rows (doc_id, text), in pieces of at most so many bytes of text, or of a single row."""
    for part, texts in parts(batch, size):
        rows = []
        for text in texts:
            tokens = shingle_set(text, words, hashes)
            n = len(tokens)
            if not n:
                rows.append((0, None, None, None))
                continue
            kind, first = size_class(n), prefix(tokens, common, percent)
            keys = _mixed(first ^ CLASS_MARKS[kind])
            if 100 * n >= percent << (kind + 1):
                keys = np.concatenate([keys, _mixed(first ^ CLASS_MARKS[kind + 1])])
            rows.append((n, xxhash.xxh3_128_hexdigest(tokens.tobytes()), signature(tokens, kind).tobytes(), keys.view(np.int64)))
        kinds = (pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()))
        made = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([part.column(0), *made], names=["doc_id", "n_shingles", "set_key", "sig", "keys"])


def _groups(reps: DataFrame) -> DataFrame:
    """(key, doc_id, pivot, size) of groups of two or more; groups with the same members are kept once."""
    # The join asks for keys that are not null; asked for here, both uses of the rows are alike and share one exchange.
    rows = reps.select("doc_id", F.explode("keys").alias("key")).where("key is not null").repartition("key")
    facts = rows.groupBy("key").agg(
        F.count("*").alias("size"),
        F.min("doc_id").alias("pivot"),
        F.max("doc_id").alias("last"),
        F.bit_xor(F.xxhash64("doc_id")).alias("mark"),
        F.bit_xor(F.xxhash64(F.lit(1), "doc_id")).alias("mark2"),
    )
    kept = (
        facts.where("size > 1 and pivot < last")
        .groupBy("size", "pivot", "last", "mark", "mark2")
        .agg(F.min("key").alias("key"))
        .select("key", "size", "pivot")
    )
    return staged(rows.join(kept, "key"), "groups")


def first_candidates(members: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(key, a, b) of the pairs of each block of a group that its tree lets through; rows without a pair name groups that need more.

    A block with more than `CANDIDATES` a member gives one for each member, the group's smallest member if that is in reach, else the
    first one, and its group needs more; so do groups of several blocks.
    """
    blocks = F.ceil(F.col("size") / BLOCK)
    own = F.pmod(F.xxhash64("doc_id"), blocks)
    everywhere = F.col("doc_id") == F.col("pivot")
    places = F.when(everywhere, F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array(own))
    dealt = members.select("key", "pivot", "doc_id", (blocks > 1).alias("cut"), F.explode(places).alias("block"))
    dealt = dealt.join(reps.select("doc_id", "n_shingles", "sig"), "doc_id")
    keys = ["key", "block"]

    def traverse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        unfinished: list[int] = []
        for group in runs(batches, keys):
            ids, key = group["doc_id"].astype(np.int64), int(group["key"][0])
            i, j = own_candidates(group, percent)
            crowded = len(i) > CANDIDATES * len(ids)
            if crowded:
                to_pivot = ids[i] == int(group["pivot"][0])
                order = np.lexsort((i, ~to_pivot, j))
                at = order[np.unique(j[order], return_index=True)[1]]
                i, j = i[at], j[at]
            if crowded or group["cut"][0]:
                unfinished.append(key)
            if len(i):
                a, b = ids[i], ids[j]
                held.append((np.full(len(a), key), np.minimum(a, b), np.maximum(a, b)))
            if len(held) >= 10_000:
                yield _pairs(held, [])
                held = []
        yield _pairs(held, unfinished)

    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "n_shingles", "doc_id")
    return dealt.mapInPandas(traverse, "key long, a long, b long")


def _pairs(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], unfinished: list[int]) -> pd.DataFrame:
    """Distinct pairs, each with one of its keys, and a row without a pair for each unfinished group."""
    key, a, b = (np.concatenate([np.zeros(0, np.int64), *(part[k] for part in held)]) for k in range(3))
    pairs = pd.DataFrame({"key": key, "a": a, "b": b}).drop_duplicates(["a", "b"])
    more = pd.DataFrame({"key": np.unique(np.array(unfinished, np.int64))})
    return pd.concat([pairs, more]).astype({"key": "int64", "a": "Int64", "b": "Int64"})


def own_candidates(group: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the members that survive a traversal of a block's tree against itself, each pair from both sides of the smallest member.

    The smallest member of the group comes as i only; of other pairs, the one that comes first is i.
    """
    n = len(group["doc_id"])
    if n == 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids, sizes = group["doc_id"].astype(np.int64), group["n_shingles"].astype(np.int64)
    pivot = ids == int(group["pivot"][0])
    sigs = fitted(group["sig"].tolist())
    if n <= FAN:  # one node: its members are compared as they are
        i, j = np.triu_indices(n, 1)
        level = _Tree.leaves(sigs, sizes, np.arange(n))
        ok = _survive(level, level, i, j, percent)
        i, j = i[ok], j[ok]
    else:
        tree = _Tree(sigs, sizes, np.arange(n))
        i, j = linked_candidates(tree, tree, percent)
        i, j = i[i < j], j[i < j]
    swap = pivot[j]
    return np.where(swap, j, i), np.where(swap, i, j)


def token_sets(ids: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(doc_id, tokens) of the given ids, made from their texts again and written."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for part, own in parts(batch, PIECE_BYTES):
                found = pa.array([shingle_set(t, words, hashes).tobytes() for t in own], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), found], names=["doc_id", "tokens"])

    ids = staged(ids.select("doc_id").distinct(), "ids")
    return staged(texts.join(ids, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(sets, "doc_id long, tokens binary"), "sets")


def alike(x: bytes, y: bytes, percent: int) -> bool:
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
    return 100 * common >= percent * (len(x) + len(y) - common)


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the percentage, compared on all shingles."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in cuts(batch.column(2), PIECE_BYTES):
                part = batch.slice(start, end - start)
                keep = [alike(x, y, percent) for x, y in zip(*(part.column(k).to_pylist() for k in (2, 3)), strict=True)]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    known = token_sets(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), texts, words)
    left, right = (known.select(F.col("doc_id").alias(i), F.col("tokens").alias(t)) for i, t in (("a", "x"), ("b", "y")))
    both = pairs.join(left, "a").join(right, "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


class _Tree:
    """Levels of nodes over members sorted by component and size; level 0 holds the members."""

    @staticmethod
    def leaves(sigs: np.ndarray, sizes: np.ndarray, comps: np.ndarray) -> tuple:
        return sigs, sizes, sizes, comps, comps, sizes - np.bitwise_count(sigs).sum(1, dtype=np.int64)

    def __init__(self, sigs: np.ndarray, sizes: np.ndarray, comps: np.ndarray):
        self.levels = [self.leaves(sigs, sizes, comps)]
        while len(self.levels[-1][0]) > 1:
            sigs, low, high, first, last, excess = self.levels[-1]
            at = np.arange(0, len(sigs), FAN)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(sigs, at),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.minimum.reduceat(first, at),
                    np.maximum.reduceat(last, at),
                    np.maximum.reduceat(excess, at),
                )
            )


def _survive(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which node pairs can hold a link between two components."""
    (xs, xl, xh, xf, xt, xe), (ys, yl, yh, yf, yt, ye) = x, y
    ok = (100 * xh[i] >= percent * yl[j]) & (100 * yh[j] >= percent * xl[i])
    ok &= ~((xf[i] == xt[i]) & (xf[i] == yf[j]) & (yf[j] == yt[j]))
    at = np.flatnonzero(ok)
    # The bitmaps of large sets are wide, so pieces are bounded by bytes.
    for part in np.array_split(at, len(at) * max(1, xs.shape[1]) // PIECE_WORDS + 1):
        a, b = i[part], j[part]
        overlap = np.bitwise_count(xs[a] & ys[b]).sum(1, dtype=np.int64) + np.minimum(xe[a], ye[b])
        ok[part] = (100 + percent) * overlap >= percent * (xl[a] + yl[b])
    return ok


def linked_candidates(left: _Tree, right: _Tree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Member pairs that survive a traversal of both trees from their roots; both trees have the same depth."""
    depth = max(len(left.levels), len(right.levels)) - 1
    for tree in (left, right):
        tree.levels += [tree.levels[-1]] * (depth + 1 - len(tree.levels))
    i = j = np.zeros(1, np.int64)
    for level in range(depth, -1, -1):
        x, y = left.levels[level], right.levels[level]
        keep = np.concatenate(
            [_survive(x, y, a, b, percent) for a, b in zip(*(np.array_split(v, len(v) // 500_000 + 1) for v in (i, j)), strict=True)]
        )
        if left is right:
            keep &= i <= j
        i, j = i[keep], j[keep]
        if level and len(i):
            (i, j) = _children(i, j, left, right, level)
    return i, j


def _children(i, j, left, right, level):
    def of(tree, k):
        if tree.levels[level] is tree.levels[level - 1]:
            return k[:, None]
        return k[:, None] * FAN + np.arange(FAN)

    a, b = of(left, i), of(right, j)
    a, b = np.broadcast_arrays(a[:, :, None], b[:, None, :])
    a, b = a.ravel(), b.ravel()
    ok = (a < len(left.levels[level - 1][0])) & (b < len(right.levels[level - 1][0]))
    return a[ok], b[ok]


def _tree_links(
    members: DataFrame, reps: DataFrame, comps: DataFrame, texts: DataFrame, words: int, percent: int
) -> DataFrame:
    """Links (a, b) between different components of a group.

    A pair of blocks with few candidates returns these, and they are verified like other pairs. One with more
    than `CANDIDATES` a member is dealt out again with the whole sets of its members, is compared where it
    lies, and returns a spanning forest of its links. So a large group of texts just below the threshold makes no
    rows for its pairs.

    In a group, members of its largest component and the others go to blocks of their own, so blocks of
    the largest component never meet each other.
    """
    here = members.where("size > 2").join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    here = here.withColumn("component", F.coalesce("component", "doc_id"))
    parts = here.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = (
        parts.groupBy("key")
        .agg(F.max(F.struct("n", F.col("component").alias("c"))).alias("top"), F.sum("n").alias("all"))
        .where("all > top.n")
        .select(
            "key",
            F.col("top.c").alias("major"),
            F.ceil(F.col("top.n") / BLOCK).alias("n_major"),
            F.ceil((F.col("all") - F.col("top.n")) / BLOCK).alias("n_minor"),
        )
    )
    rows = here.join(mixed, "key").select(
        "key",
        "doc_id",
        "component",
        "n_major",
        "n_minor",
        F.when(
            F.col("component") == F.col("major"), F.col("n_minor") + F.pmod(F.xxhash64("doc_id"), "n_major")
        )
        .otherwise(F.pmod(F.xxhash64("doc_id"), "n_minor"))
        .alias("block"),
    )
    own = F.col("block")
    partners = F.when(
        own < F.col("n_minor"),
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("n_minor") + F.col("n_major") - 1),
            lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")),
        ),
    ).otherwise(
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("n_minor") - 1), lambda k: F.struct(k.alias("i"), own.alias("j"))
        )
    )
    dealt = rows.withColumn("pair", F.explode(partners)).select("key", "pair.i", "pair.j", "block", "doc_id", "component")
    dealt = staged(dealt, "dealt")
    keys = ["key", "i", "j"]

    def ordered(extra: DataFrame) -> DataFrame:
        return spread(dealt.join(extra, "doc_id"), *keys).sortWithinPartitions(*keys, "component", "n_shingles", "doc_id")

    def traverse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, keys):
            a, b = block_candidates(group, percent)
            if len(a) > CANDIDATES * len(group["doc_id"]):
                yield pd.DataFrame({k: group[k][:1] for k in keys} | {"a": [None], "b": [None]})
            elif len(a):
                ids = group["doc_id"].astype(np.int64)
                yield pd.DataFrame({k: group[k][0] for k in keys} | {"a": ids[a], "b": ids[b]})

    narrow = reps.select("doc_id", "n_shingles", "sig")
    found = staged(ordered(narrow).mapInPandas(traverse, "key long, i long, j long, a long, b long"), "candidates")
    few = found.where("a is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = verified(staged(few, "pairs"), texts, words, percent)
    full = found.where("a is null").select(*keys)
    if full.isEmpty():
        return links
    dealt = staged(dealt.join(full, keys, "left_semi"), "dealt")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, keys):
            a, b = spanning(group, percent)
            yield pd.DataFrame({"a": a, "b": b})

    whole = narrow.join(token_sets(dealt, texts, words).dropDuplicates(["doc_id"]), "doc_id")
    return links.unionByName(ordered(whole).mapInPandas(compare, "a long, b long").distinct())


def spanning(group: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of links that connect all members of two blocks that links connect; what is connected is not compared."""
    ids, label, out = group["doc_id"].astype(np.int64), {}, []

    def root(x: int) -> int:
        while label.setdefault(x, x) != x:
            label[x] = x = label[label[x]]
        return x

    start = np.unique(group["component"].astype(np.int64), return_inverse=True)[1].tolist()
    for a, b in zip(*(v.tolist() for v in block_candidates(group, percent)), strict=True):
        x, y = root(start[a]), root(start[b])
        if x != y and alike(group["tokens"][a], group["tokens"][b], percent):
            label[max(x, y)] = min(x, y)
            out.append((ids[a], ids[b]))
    return np.array([a for a, _ in out], np.int64), np.array([b for _, b in out], np.int64)


def block_candidates(group: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs between blocks i and j of a group that may link two components."""
    sizes, ids, comps, block = (group[c].astype(np.int64) for c in ("n_shingles", "doc_id", "component", "block"))
    sigs = fitted(group["sig"].tolist())
    left, right = (np.flatnonzero(block == group[side][0]) for side in ("i", "j"))
    if not len(left) or not len(right):
        return left[:0], right[:0]
    x, y = (_Tree(sigs[at], sizes[at], comps[at]) for at in (left, right))
    i, j = linked_candidates(x, y, percent)
    a, b = left[i], right[j]
    return a[ids[a] != ids[b]], b[ids[a] != ids[b]]


def jaccard_components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest id that links lead to.

    Null or empty texts: 0 shingles, a component of their own. An empty table gives no rows.
    """
    texts = _texts(docs, id_col, text_col)
    rows = staged(described(texts, words, percent).withColumn("row", F.monotonically_increasing_id()), "shingles")
    sets = rows.where("set_key is not null").select("set_key", "doc_id", "row")
    classes = sets.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    # The rows that are not the first of their set are mostly few, so they are taken out of the wide rows, and not the others put in.
    kept = sets.where("doc_id is not null").groupBy("set_key").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    copies = sets.join(kept, "set_key", "left").where("first is null or row <> first.row").select("row")
    reps = rows.where("set_key is not null").join(staged(copies, "copies"), "row", "left_anti")
    members = _groups(reps)
    reps = staged(reps.select("doc_id", "n_shingles", "sig"), "reps")
    found = staged(first_candidates(members, reps, percent), "candidates")
    pairs = staged(found.where("a is not null").select("a", "b").distinct(), "pairs")
    links = staged(verified(pairs, texts, words, percent), "links")
    first = components(links)
    left = members.join(found.where("a is null").select("key").distinct(), "key", "left_semi")
    more = _tree_links(left, reps, first, texts, words, percent)
    first = components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    found = classes.join(first.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_key", F.coalesce("component", "rep").alias("found")
    )
    return rows.join(found, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce(F.least("found", "doc_id"), "doc_id")).alias("component_id"),
    )


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


ORACLE = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT doc_id, unnest(list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k + 3], ' ')) END)) AS s
    FROM words
), sizes AS (
    SELECT d.doc_id, count(s.s) AS n FROM documents d LEFT JOIN shingles s USING (doc_id) GROUP BY 1
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * o >= 85 * (p.n + q.n - o)
), reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT s.doc_id, s.n AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id
FROM sizes s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.n
"""
