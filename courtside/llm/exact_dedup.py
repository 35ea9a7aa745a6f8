r"""Exact dedup: an extendible-hash index whose buckets are key ranges of a 64-bit hash of the text.

Texts are equal when identical after every `[\x20\x09-\x0D]+` became one space; a null text is an empty
one. Of equal texts the row with the smallest id stays (a null id only if there is no other).

1. Each piece of an Arrow batch sends one head per distinct text: its smallest row and the number of rows. So a text
   that fills a third of the table reaches its owner once a piece, not once a row.
2. The directory begins with one bit of the hash. In rounds, buckets over `BUCKET_BYTES` that hold more than one
   hash are split by one more bit; the directory doubles when a bucket to split is as deep as it is. Buckets end at `MAX_DEPTH` bits, so
   that a histogram of that many bits is all the rounds need, and the broadcast directory has at most 2^MAX_DEPTH slots.
3. Each bucket's owner task reads its heads in hash order, chains texts of equal hash and compares their
   bytes. It holds the chain of one hash at a time.
4. The resolved entries are written to the shared folder as the index. Every row is looked up there by the bucket that the directory
   gives its hash and by the hash; within the chain, by the digest of its bytes.

Empty tables give no rows. Rows that repeat an id and a text are one document: all are marked as kept,
`survivors` returns one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.plaintext import cuts, parts
from courtside.llm.tables import columns_of, named, ship, spread, staged, table

BUCKET_BYTES = 1 << 20
MAX_DEPTH = 16
PIECE = 4 << 20
SPACE = b" \t\n\x0b\x0c\r"


def normalised(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return b" " if raw else b""
    return b" " * (raw[0] in SPACE) + b" ".join(words) + b" " * (raw[-1] in SPACE)


def text_hash(norm: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(norm)).view(np.int64))


def _order(doc_id: int | None) -> tuple:
    return (doc_id is None, doc_id or 0)


def heads(docs: DataFrame, id_col: str, text_col: str, hash_of: Callable[[bytes], int] = text_hash) -> DataFrame:
    """(doc, h, n): per piece of a batch and distinct text its smallest row, the text's hash and the rows it stands for."""
    rows = docs.select(F.struct(*columns_of(docs)).alias("doc"))
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_texts = pc.struct_field(batch.column(0), [text_at]).cast(pa.string())
            all_ids = pc.struct_field(batch.column(0), [id_at]).cast(pa.int64())
            for start, end in cuts(all_texts, PIECE):
                found: dict[bytes, list] = {}
                ids = all_ids.slice(start, end - start).to_pylist()
                for i, text in enumerate(all_texts.slice(start, end - start).to_pylist()):
                    entry = found.setdefault(normalised(text), [i, 0])
                    entry[1] += 1
                    if _order(ids[i]) < _order(ids[entry[0]]):
                        entry[0] = i
                at = pa.array([start + i for i, _ in found.values()], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at),
                        pa.array(map(hash_of, found), pa.int64()),
                        pa.array([n for _, n in found.values()], pa.int64()),
                    ],
                    names=["doc", "h", "n"],
                )

    kind = T.StructType([T.StructField("doc", rows.schema["doc"].dataType), *_longs("h", "n")])
    return rows.mapInArrow(reduce, kind)


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


def digests(docs: DataFrame, id_col: str, text_col: str, hash_of: Callable[[bytes], int] = text_hash) -> DataFrame:
    """Per row: doc_id, h, text_sha256 and the number of bytes of the normalised text."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts(batch, 1 << 20):
                norms = [normalised(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(map(hash_of, norms), pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in norms], pa.string()),
                        pa.array(map(len, norms), pa.int64()),
                    ],
                    names=["doc_id", "h", "text_sha256", "size"],
                )

    rows = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"))
    return rows.mapInArrow(digest, "doc_id long, h long, text_sha256 string, size long")


def grown(sizes: np.ndarray, hashes: np.ndarray, bucket_bytes: int) -> tuple[np.ndarray, int]:
    """The directory's bucket by slot, and its depth in bits, from bytes and distinct hashes by the first MAX_DEPTH bits.

    A bucket is named after its first slot.
    """
    depth, buckets = 1, [(1, 0), (1, 1)]
    done = []
    while buckets:
        split = []
        for d, q in buckets:
            own = slice(q << (MAX_DEPTH - d), (q + 1) << (MAX_DEPTH - d))
            over = sizes[own].sum() > bucket_bytes and hashes[own].sum() > 1 and d < MAX_DEPTH
            (split if over else done).append((d, q))
        depth = max([depth, *(d + 1 for d, _ in split)])
        buckets = [(d + 1, 2 * q + bit) for d, q in split for bit in (0, 1)]
    slots = np.empty(1 << depth, np.int64)
    for d, q in done:
        slots[q << (depth - d) : (q + 1) << (depth - d)] = q << (depth - d)
    return slots, depth


def directory(hashes: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """(slot, bucket) of the directory over rows of (h, size), and its depth in bits.

    Equal hashes count once, as equal texts reach the owner a few times only. The histogram has 2^MAX_DEPTH rows at most.
    """
    fine = (
        hashes.groupBy("h").agg(F.max("size").alias("size"))
        .groupBy(F.shiftrightunsigned("h", 64 - MAX_DEPTH).alias("p")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    ).toPandas()
    sizes, counts = np.zeros((2, 1 << MAX_DEPTH), np.int64)
    sizes[fine["p"].to_numpy(np.int64)] = fine["size"].to_numpy(np.int64)
    counts[fine["p"].to_numpy(np.int64)] = fine["n"].to_numpy(np.int64)
    slots, depth = grown(sizes, counts, bucket_bytes)
    rows = pd.DataFrame({"slot": np.arange(len(slots)), "bucket": slots})
    return hashes.sparkSession.createDataFrame(rows, "slot long, bucket long"), depth


def _located(rows: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """Adds the bucket of each row's hash."""
    return rows.withColumn("slot", F.shiftrightunsigned("h", 64 - depth)).join(F.broadcast(slots), "slot").drop("slot")


def _owned(docs: DataFrame, slots: DataFrame, depth: int, id_col: str, text_col: str, hash_of: Callable[[bytes], int]) -> DataFrame:
    rows = _located(heads(docs, id_col, text_col, hash_of), slots, depth).select(
        "bucket",
        "h",
        "n",
        F.col("doc").getField(id_col).cast("long").alias("id"),
        "doc",
    )
    return spread(rows, "bucket").sortWithinPartitions("bucket", "h")


class _Chain:
    """The distinct texts of one hash: their bytes, smallest row and number of rows."""

    def __init__(self, h: int):
        self.h, self.entries = h, []

    def add(self, norm: bytes, batch: pa.RecordBatch, i: int, doc_id: int | None, n: int) -> None:
        for entry in self.entries:
            if entry[0] == norm:
                entry[4] += n
                if _order(doc_id) < _order(entry[3]):
                    entry[1:4] = batch, i, doc_id
                return
        self.entries.append([norm, batch, i, doc_id, n])


def chains(batches: Iterable[pa.RecordBatch], text_at: int) -> Iterator[list]:
    """[text, batch, row, id, rows] of each distinct text, which is that field of doc; the batches come in order of h."""
    now = None
    for batch in batches:
        texts = pc.struct_field(batch.column("doc"), [text_at]).cast(pa.string())
        for start, end in cuts(texts, PIECE):
            part = batch.slice(start, end - start)
            columns = (part.column(c).to_pylist() for c in ("h", "n", "id"))
            own = texts.slice(start, end - start).to_pylist()
            for i, (h, n, doc_id, text) in enumerate(zip(*columns, own, strict=True), start):
                if now is None or h != now.h:
                    yield from now.entries if now else ()
                    now = _Chain(h)
                now.add(normalised(text), batch, i, doc_id, n)
    yield from now.entries if now else ()


def duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    hash_of: Callable[[bytes], int] = text_hash,
) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256. hash_of: a text's place in the index, as a signed 64-bit number."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rows = kind.names, []
        for norm, _, _, doc_id, n in chains(batches, 1):
            rows.append((hash_of(norm), hashlib.sha256(norm).hexdigest(), doc_id, n))
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kind)
                rows = []
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kind)

    kind = pa.schema([("h", pa.int64()), ("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
    own = docs.select(named(id_col).alias("i"), named(text_col).alias("t"))
    rows = staged(digests(own, "i", "t", hash_of), "digests")
    slots, depth = directory(rows, bucket_bytes)
    owned = _owned(own, slots, depth, "i", "t", hash_of)
    index = staged(owned.mapInArrow(entries, "h long, text_sha256 string, keep_id long, group_size long"), "index")
    return _located(rows, slots, depth).join(_located(index, slots, depth), ["bucket", "h", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def survivors(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """One whole row of each group of equal texts, with all its columns."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for _, batch, i, _, _ in chains(batches, text_at):
            held.append(batch.select(["doc"]).slice(i, 1))
            if len(held) == 200:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    ship(docs.sparkSession)
    text_at = docs.columns.index(text_col)
    slots, depth = directory(digests(docs, id_col, text_col), bucket_bytes)
    rows = _owned(docs, slots, depth, id_col, text_col, text_hash)
    kept = rows.mapInArrow(keep, T.StructType([rows.schema["doc"]]))
    return kept.select("doc.*")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH n AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
    SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)
"""
