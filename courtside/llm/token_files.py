"""Token-ID output: frequency-ranked ids in a byte-aligned variable-length code with separate control bytes.

The more frequent an id, the smaller its rank, and the fewer bytes its rank takes: one to four. Two bits an id in
the control bytes hold that number; the reader looks a control byte up in a table of 256 entries for the
lengths of four ids, and numpy scatters the data bytes by them.

A file is a sequence of blocks, all numbers little-endian:

    magic b"TIDS", u32 documents, u64 ids, u64 data bytes,
    documents x i64 doc_id, documents x u8 (1: doc_id is null), documents x u32 ids of the document,
    the control bytes, each document's beginning with a byte of its own, the data bytes, b"\\n"

Texts are encoded once, each different piece once while it is cached, into a staged table, which is deleted in the end; the counts of ids and then the coded documents are made from it.

Files are numbered in ascending order of doc_id (nulls first), and so are the documents in them. Spark's text writer
puts them into any store it can write to: a block is the bytes of a line. The table of ranks lies beside the files.

Each document ends with the id `end`. Null and empty texts have that id only; an empty table makes
no blocks; rows that repeat an id lie next to each other, in the order of their coded bytes.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from courtside.llm.plaintext import byte_alphabet, cuts, parts, plain_bytes, tokenizer_file
from courtside.llm.tables import ship, staged, table
from courtside.session import discard, scratch_folder

CACHED = 500_000
RUN_CHARS = 20_000
#: Texts of about so many bytes are cut at a time; the more, the fewer look-ups.
PART_BYTES = 8_000_000
BLOCK_IDS = 1 << 18
FILE_IDS = 1 << 24
#: Coding takes some fifty bytes for each of an id's.
CODED_BYTES = 1 << 20
HEADER = struct.Struct("<4sIQQ")
MAGIC = b"TIDS"
#: Lengths of the four ids that a control byte stands for.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


#: Classes of plain characters: white space, letters, numbers, others.
BLANK, LETTER, NUMBER, OTHER = range(4)
KINDS = np.array([BLANK if c.isspace() else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], OTHER) for c in map(chr, range(256))], np.uint8)
#: What byte-level files cut off after an apostrophe that begins a piece.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def piece_bounds(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the pieces of texts of plain characters begin, as byte-level files cut them, and where the last one ends.

    `data` has the texts in Latin-1, one after the other. A piece is a run of letters, of numbers or of other characters, with one space
    before it, or an apostrophe with an ending, or white space, of which the last character is apart if something follows.
    """
    n, kinds = len(data), KINDS[data]
    blank = kinds == BLANK
    begins = np.zeros(n + 1, bool)
    begins[0], begins[ends] = True, True
    at = begins.copy()
    at[1:n] |= (kinds[1:] != kinds[:-1]) & (data[:-1] != ord(" "))
    at[1 : n - 1] |= blank[1:-1] & blank[:-2] & ~blank[2:] & ~begins[2:n]
    marks = np.flatnonzero((data == ord("'")) & at[:n])
    if len(marks):
        last = ends[np.searchsorted(ends, marks, "right")]
        after = np.concatenate([data, np.zeros(2, np.uint8)])
        for ending in ENDINGS:
            held = (marks + len(ending) < last) & np.all([after[marks + k] == ord(c) for k, c in enumerate(ending, 1)], 0)
            at[marks[held] + 1] = False
            at[marks[held] + 1 + len(ending)] = True
    return np.flatnonzero(at)


class ByteCoder:
    """Encodes with a byte-level BPE file, each different piece once, with a bounded cache."""

    def __init__(self, path: str, kind: str = "<u4"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.kind = np.dtype(kind)
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        vocab = self.whole.get_vocab()
        #: How many bytes of text each id stands for.
        self.sizes = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        for token, number in vocab.items():
            self.sizes[number] = len(token)
        spec = json.loads(Path(path).read_text())
        cutter = spec["pre_tokenizer"] or {}
        #: Whether the file cuts texts as `piece_bounds` does.
        self.cuts_known = not spec["normalizer"] and [cutter.get(k) for k in ("type", "use_regex", "add_prefix_space")] == ["ByteLevel", True, False]
        lines = {"type": "Split", "pattern": {"String": "\n"}, "behavior": "Removed", "invert": False}
        alone = {"added_tokens": [], "normalizer": None, "pre_tokenizer": lines, "post_processor": None, "truncation": None, "padding": None}
        #: The file's model for pieces that are cut already, a line each, in symbols.
        self.by_line = Tokenizer.from_str(json.dumps(spec | alone))
        alphabet = byte_alphabet()
        self.space, self.symbols = alphabet[ord(" ")], {b: c for b, c in alphabet.items() if b != ord("\n")}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _plain(self, text: str) -> bytes | None:
        """The text in Latin-1 if numpy can cut it: plain, without an added token."""
        return None if not self.cuts_known or any(a in text for a in self.added) else plain_bytes(text)

    def chunks(self, text: str) -> list[str] | None:
        """The pieces of a text; None if it can't be cut so."""
        if (plain := self._plain(text)) is None:
            return None
        bounds = piece_bounds(np.frombuffer(plain, np.uint8), np.array([len(plain)]))
        return [text[i:j] for i, j in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as numbers of the coder's kind."""
        plain = [self._plain(t) for t in texts]
        found = iter(self._encode_plain([p for p in plain if p is not None]))
        others = iter(self._encode([t for t, p in zip(texts, plain, strict=True) if p is None]))
        return [next(others if p is None else found) for p in plain]

    def _encode_plain(self, texts: list[bytes]) -> list[bytes]:
        """Arrow numbers the different pieces of all texts, so that each is looked up once, and puts their ids in the texts' order."""
        data = b"".join(texts)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        bounds = piece_bounds(np.frombuffer(data, np.uint8), ends)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(data)]
        pieces = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).dictionary_encode()
        different = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = pa.array(self._piece_codes(different), pa.large_binary()).take(pieces.indices)
        flat = memoryview(codes.buffers()[2] or b"")
        at = np.frombuffer(codes.buffers()[1], np.int64, len(bounds))[np.searchsorted(bounds, ends)].tolist()
        return [bytes(flat[i:j]) for i, j in zip([0, *at], at, strict=False)]

    def _piece_codes(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of different pieces."""
        if len(self.known) > CACHED:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        codes = list(map(known.get, pieces))
        new = []
        for piece in [p for p, code in zip(pieces, codes, strict=True) if code is None]:
            if (code := older.get(piece)) is None:
                new.append(piece)
            else:
                known[piece] = code
        known.update(self._line_codes(new))
        rest = [p for p in new if p not in known]
        known.update(zip(rest, self._encode_chunks([p.decode("latin-1") for p in rest]), strict=True))
        return [known[p] if code is None else code for p, code in zip(pieces, codes, strict=True)]

    def _line_codes(self, pieces: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Pieces with their ids, in the vocabulary's symbols and a line each, so that nothing has to cut them; those of white space are left out."""
        for ascii_only in (True, False):
            own = [p for p in pieces if p.isascii() == ascii_only and not p.isspace()]
            runs, texts = _runs(own, [len(p) + 1 for p in own]), []
            for run in runs:
                text = b"\n".join(run).decode("latin-1")
                texts.append(text.replace(" ", self.space) if ascii_only else text.encode().decode("latin-1").translate(self.symbols))
            for run, codes in zip(runs, self._encode(texts, self.by_line), strict=True):
                lengths = [len(p) if ascii_only else len(p.decode("latin-1").encode()) for p in run]
                yield from ((p, code) for p, code in zip(run, self._cut(codes, lengths, 0), strict=True) if code is not None)

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of pieces, many of them in one text: no piece reaches over a space, nor over a line feed between two that have none there.

        A token's bytes tell where it lies, so the ids are cut at the pieces' ends. Should a token lie across one, the pieces are encoded alone.
        """
        out: list[bytes | None] = [None] * len(chunks)
        runs = [
            (between, run)
            for between, places in (
                ("", [k for k, c in enumerate(chunks) if c[:1] == " "]),
                ("\n", [k for k, c in enumerate(chunks) if c and c[0] not in " \n"]),
            )
            for run in _runs(places, [len(chunks[k]) for k in places])
        ]
        texts = [between.join([chunks[k] for k in places]) for between, places in runs]
        for (between, places), codes in zip(runs, self._encode(texts), strict=True):
            lengths = [len(chunks[k].encode()) for k in places]
            for k, code in zip(places, self._cut(codes, lengths, len(between)), strict=True):
                out[k] = code
        rest = [k for k, code in enumerate(out) if code is None]
        for k, code in zip(rest, self._encode([chunks[k] for k in rest]), strict=True):
            out[k] = code
        return out

    def _cut(self, codes: bytes, lengths: list[int], between: int) -> Iterator[bytes | None]:
        """The ids of strings of so many bytes that were encoded together, with so many bytes between two; None where a token lies across an end."""
        width = self.kind.itemsize
        sizes = np.array(lengths, np.int64) + between
        ends = np.cumsum(sizes) - between
        starts = ends - sizes + between
        past = np.concatenate([[0], np.cumsum(self.sizes[np.frombuffer(codes, self.kind)])])
        first, last = np.searchsorted(past, starts), np.searchsorted(past, ends)
        whole = (past[np.minimum(first, len(past) - 1)] == starts) & (past[np.minimum(last, len(past) - 1)] == ends)
        for a, b, ok in zip((width * first).tolist(), (width * last).tolist(), whole.tolist(), strict=True):
            yield codes[a:b] if ok else None

    def _encode(self, texts: list[str], use: Tokenizer | None = None) -> list[bytes]:
        found = (use or self.whole).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]


def _runs(items: list, sizes: list[int]) -> list[list]:
    """The items in runs of about RUN_CHARS characters."""
    bounds = np.flatnonzero(np.diff(np.cumsum(np.array(sizes, np.int64)) // RUN_CHARS)) + 1
    return [items[a:b] for a, b in zip([0, *bounds.tolist()], [*bounds.tolist(), len(items)], strict=True) if a < b]


@functools.lru_cache(maxsize=2)
def coder(path: str, kind: str = "<u4") -> ByteCoder:
    """The coder of a file, made once in a Python worker."""
    return ByteCoder(path, kind)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def id_kind(path: str, end: int) -> str:
    """The numpy type that staged ids take: two bytes if the vocabulary fits."""
    return "<u2" if max(coder(path).whole.get_vocab_size(), end + 1) <= 1 << 16 else "<u4"


def tokenized(rows: DataFrame, path: str, tokenizer: str, end: int) -> DataFrame:
    """(doc_id, ids with the end id) of rows (doc_id, text), written to a folder and read again."""
    kind = id_kind(tokenizer, end)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, stop = coder(tokenizer, kind), np.array([end], kind).tobytes()
        for batch in batches:
            for part, texts in parts(batch, PART_BYTES):
                codes = [c + stop for c in use.encode_texts(texts)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(codes, pa.binary())], names=["doc_id", "ids"])

    rows.mapInArrow(encode, "doc_id long, ids binary").write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.parquet(path)


def _flat(column: pa.BinaryArray, kind: str) -> np.ndarray:
    """The numbers of all values of a binary column, one after the other."""
    ends = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].view(kind)


def _cut(data: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """A binary column of values of so many bytes."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def id_counts(staged_ids: DataFrame, kind: str) -> DataFrame:
    """(id, n) over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder.cache_clear()
        total = np.zeros(1, np.int64)
        for batch in batches:
            found = np.bincount(_flat(batch.column(0), kind), minlength=len(total))
            found[: len(total)] += total
            total = found
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    return staged_ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def pack(ranks: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes, data bytes, and how many data bytes each of the documents of so many ids has."""
    lengths = 1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(int(((sizes + 3) // 4 * 4).sum()), np.uint8)
    codes[_real(sizes)] = lengths - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    before = np.concatenate([[0], np.cumsum(lengths)])
    ends = np.cumsum(sizes)
    return control, data, before[ends] - before[ends - sizes]


def _real(sizes: np.ndarray) -> np.ndarray:
    """Which places of control bytes stand for an id; documents begin with a byte each."""
    padded = (sizes + 3) // 4 * 4
    return np.arange(padded.sum()) - np.repeat(np.cumsum(padded) - padded, padded) < np.repeat(sizes, padded)


def unpack(control: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranks of documents of so many ids, whose control bytes begin with a byte each."""
    lengths = LENGTHS[control].ravel()[_real(sizes.astype(np.int64))]
    out = np.zeros((len(lengths), 4), np.uint8)
    out[np.arange(4) < lengths[:, None]] = data
    return out.view("<u4").ravel()


def block(ids: np.ndarray, nulls: np.ndarray, sizes: np.ndarray, control: np.ndarray, data: np.ndarray) -> bytes:
    return b"".join(
        [
            HEADER.pack(MAGIC, len(ids), int(sizes.sum()), len(data)),
            ids.astype("<i8").tobytes(),
            nulls.astype(np.uint8).tobytes(),
            sizes.astype("<u4").tobytes(),
            control.tobytes(),
            data.tobytes(),
        ]
    )


def blocks(content: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_ids, nulls, ids per document, ranks) of each block of a file."""
    at = 0
    while at < len(content):
        magic, docs, n, size = HEADER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no block begins at byte {at}")
        at += HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, kind, count, at)
            at += found.nbytes
            return found

        ids, nulls, lengths = take("<i8", docs), take("u1", docs), take("<u4", docs)
        control, data = take("u1", int(((lengths.astype(np.int64) + 3) // 4).sum())), take("u1", size)
        ranks = unpack(control, data, lengths)
        if len(ranks) != n:
            raise ValueError(f"a block has {len(ranks)} ids and not {n}")
        yield ids, nulls, lengths, ranks
        at += 1


def coded(batch: pa.RecordBatch, rank_of: np.ndarray, ends: np.ndarray, kind: str, size: int = CODED_BYTES) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, control, data, file) of rows (doc_id, ids), in pieces of at most so many bytes of ids, or of a single row."""
    for a, b in cuts(batch.column(1), size):
        doc_id, codes = (batch.column(k).slice(a, b - a) for k in (0, 1))
        sizes = pc.binary_length(codes).to_numpy().astype(np.int64) // np.dtype(kind).itemsize
        control, data, lengths = pack(rank_of[_flat(codes, kind)], sizes)
        ids, nulls = _ids(doc_id)
        file = np.where(nulls, 0, np.searchsorted(ends, ids.astype(np.float64)))
        yield pa.RecordBatch.from_arrays(
            [doc_id, pa.array(sizes), _cut(control, (sizes + 3) // 4), _cut(data, lengths), pa.array(file, pa.int32())],
            names=["doc_id", "n", "control", "data", "file"],
        )


def write(
    docs: DataFrame, path: str, tokenizer: str, *, end: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Writes the ranks to path/ranks and the files to path/ids."""
    spark, kind = docs.sparkSession, id_kind(tokenizer, end)
    found = tokenized(_texts(docs, id_col, text_col), f"{path}/encoded", tokenizer, end)
    id_counts(found, kind).write.parquet(f"{path}/ranks")
    order = _ranked(spark, path)
    rank_of = np.zeros(int(order.max()) + 1 if len(order) else 1, np.int64)
    rank_of[order] = np.arange(len(order))
    table_of = spark.sparkContext.broadcast(rank_of)
    total = spark.read.parquet(f"{path}/ranks").agg(F.sum("n")).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // FILE_IDS))
    # A file per range of ids, of about as many documents each; the coding runs once, as no sort has to sample its rows.
    shares = [k / files for k in range(1, files)]
    ends = np.array(found.approxQuantile("doc_id", shares, 0.1 / files) if shares else [], np.float64)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder.cache_clear()  # a worker lives on between stages; this one has nothing to encode any more
        for batch in batches:
            yield from coded(batch, table_of.value, ends, kind)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, nulls = _ids(batch.column(0))
            sizes = batch.column(1).to_numpy()
            control, data = (_flat(batch.column(k), "u1") for k in (2, 3))
            at, cat, dat = (
                np.concatenate([[0], np.cumsum(n)]) for n in (sizes, *(pc.binary_length(batch.column(k)).to_numpy().astype(np.int64) for k in (2, 3)))
            )
            bounds = [0, *(np.flatnonzero(np.diff(at[1:] // BLOCK_IDS)) + 1).tolist(), len(sizes)]
            made = [
                block(ids[a:b], nulls[a:b], sizes[a:b], control[cat[a] : cat[b]], data[dat[a] : dat[b]])
                for a, b in zip(bounds, bounds[1:], strict=False)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["block"])

    packed = found.mapInArrow(code, "doc_id long, n long, control binary, data binary, file int")
    ordered = packed.repartitionById(files, "file").sortWithinPartitions("doc_id", "control", "data")
    written = ordered.mapInArrow(lines, "block binary").select(F.col("block").cast("string").alias("value"))
    written.write.option("lineSep", "\n").text(f"{path}/ids")
    discard(spark, f"{path}/encoded")


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids, 0 for null ones, and which are null."""
    return pc.fill_null(column, 0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False)


def _ranked(spark: SparkSession, path: str) -> np.ndarray:
    """The ids by rank, the most frequent first; as many as the vocabulary has at most."""
    found = spark.read.parquet(f"{path}/ranks").toPandas()
    return found.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.int64)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files, in their order by (file, place): doc_id, ids (little-endian u32), start within the file."""
    ids_of = spark.sparkContext.broadcast(_ranked(spark, path).astype("<u4"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                start = place = 0
                for doc_ids, nulls, lengths, ranks in blocks(content.as_py()):
                    code = ids_of.value[ranks].tobytes()
                    ends = np.cumsum(lengths.astype(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(doc_ids), pa.int64()),
                            pa.array(place + np.arange(len(doc_ids))),
                            pa.array(doc_ids, mask=nulls.astype(bool)),
                            pa.array(start + ends - lengths),
                            pa.array([code[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]),
                        ],
                        names=["file", "place", "doc_id", "start", "ids"],
                    )
                    start += int(ends[-1])
                    place += len(doc_ids)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids")
    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("long")
    return files.where("length > 0").select(number.alias("file"), "content").mapInArrow(
        decode, "file long, place long, doc_id long, start long, ids binary"
    )


def positions(found: DataFrame) -> DataFrame:
    """Per document of `read`: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    rows = staged(found.select(
        "file", "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    ), "positions")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    first = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return rows.join(first, "file").select(
        "doc_id", (F.col("first") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


def op9_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "token-ids")
    write(table(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"), end=0)
    return positions(read(spark, path))
