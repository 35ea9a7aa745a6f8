"""Fill-in-the-middle by displacement scatter, and the inverse gather.

A text is cut between its tokens (white space before them belongs to them; white space at the end is one of its own) into prefix,
middle and suffix, which are written with a sentinel before each: `psm` as prefix, suffix, middle, `spm` as suffix, prefix,
middle. Other texts stay `plain`. The draws come from a digest of the seed and the id, so a row's form doesn't depend on where it lies.

All texts of a piece of a batch are one byte array. Token ends are scanned in one pass; every part of a text moves by one
distance, so the distances' differences are noted where the parts start, a cumulative sum gives each byte its distance, and one
numpy scatter builds all outputs of the piece. Restoring finds the sentinels, notes the distances of the parts the other way round and
gathers. Sums run over windows of `WINDOW` bytes; a piece has `PIECE` bytes or a single text.

Null texts are empty texts; empty texts, and texts that hold a sentinel, are plain. A null id draws like an empty id. Rows that repeat
an id get the same draws, each for its own text. An empty table gives no rows. `restored` gives null where an output is null or
lacks its sentinels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.tables import ship, table

SEED = 42
RATE = 50
SPM_RATE = 80
SENTINELS = ("<P>", "<S>", "<M>")
PIECE = 4 << 20
WINDOW = 1 << 19
PLAIN, PSM, SPM = range(3)
FORMS = np.array(["plain", "psm", "spm"], object)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text column; null texts are empty."""
    column = pc.fill_null(column.cast(pa.string()), "")
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    return at - at[0], np.frombuffer(data, np.uint8)[at[0] : at[-1]]


def text_column(offsets: np.ndarray, raw: np.ndarray, absent: np.ndarray | None = None) -> pa.Array:
    """The text column of (offsets, bytes), null where it is absent."""
    made = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw))
    return made if absent is None or not absent.any() else pc.if_else(pa.array(~absent), made, None)


def pieces(batch: pa.RecordBatch, column: int, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with at most so many bytes in a text column, or a single row."""
    offsets, start = text_bytes(batch.column(column))[0], 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def _distances(starts: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Per window of bytes the distance of each one, that of the last start at or before it."""
    steps, moved = np.diff(shifts, prepend=0), 0
    for a in range(0, size, WINDOW):
        b = min(a + WINDOW, size)
        i, j = np.searchsorted(starts, (a, b))
        change = np.zeros(b - a, np.int64)
        np.add.at(change, starts[i:j] - a, steps[i:j])
        change[0] += moved
        to = np.cumsum(change)
        moved = to[-1]
        to += np.arange(a, b)
        yield slice(a, b), to


def scattered(raw: np.ndarray, starts: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    """An array of so many bytes in which every byte lies its distance away from where it was."""
    out = np.zeros(size, np.uint8)
    for part, to in _distances(starts, shifts, len(raw)):
        out[to] = raw[part]
    return out


def gathered(raw: np.ndarray, starts: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    """The inverse: every byte of the result is fetched from its distance away."""
    out = np.empty(size, np.uint8)
    for part, to in _distances(starts, shifts, size):
        out[part] = raw[to]
    return out


def token_ends(offsets: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Where the tokens of all texts end, in ascending order."""
    space = _SPACE[raw]
    last = np.empty(len(raw), bool)
    last[:-1] = ~space[:-1] & space[1:]
    last[offsets[1:][np.diff(offsets) > 0] - 1] = True
    return np.flatnonzero(last) + 1


def occurrences(raw: np.ndarray, mark: bytes) -> np.ndarray:
    """Where the mark starts in the bytes, also across two texts."""
    at = np.flatnonzero(raw[: max(0, len(raw) - len(mark) + 1)] == mark[0])
    for k, byte in enumerate(mark[1:], 1):
        at = at[raw[at + k] == byte]
    return at


def found_within(offsets: np.ndarray, raw: np.ndarray, mark: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of the marks that lie within one text."""
    at = occurrences(raw, mark)
    text = np.searchsorted(offsets, at, "right") - 1
    whole = at + len(mark) <= offsets[text + 1]
    return text[whole], at[whole]


def _checked(sentinels: Sequence[str]) -> list[bytes]:
    marks = [s.encode() for s in sentinels]
    if len(marks) != 3 or not all(marks) or len(set(marks)) < 3:
        raise ValueError("three different sentinels are needed")
    for a in marks:
        for b in marks:
            if (a != b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)) + (a != b))):
                raise ValueError("sentinels must not overlap each other")
    return marks


def rearranged(
    offsets: np.ndarray, raw: np.ndarray, draws: np.ndarray, marks: list[bytes], rate: int, spm_rate: int
) -> tuple[np.ndarray, ...]:
    """(tokens, forms, prefix characters, middle characters, output offsets, output bytes) of all texts."""
    start, end = offsets[:-1], offsets[1:]
    ends = token_ends(offsets, raw)
    before = np.searchsorted(ends, start, "right")
    n = np.searchsorted(ends, end, "right") - before
    form = np.where(draws[:, 3] % 100 < spm_rate, SPM, PSM)
    form[(draws[:, 2] % 100 >= rate) | (start == end)] = PLAIN
    for mark in marks:
        form[found_within(offsets, raw, mark)[0]] = PLAIN
    cuts = np.sort(draws[:, :2] % (n + 1)[:, None], 1)
    edges = np.concatenate([[0], ends])
    first, second = (np.where(cuts[:, k] > 0, edges[np.where(cuts[:, k] > 0, before + cuts[:, k], 0)], start) for k in (0, 1))
    plain = form == PLAIN
    first, second = np.where(plain, end, first), np.where(plain, end, second)
    lengths = [first - start, end - second, second - first]
    sizes = [len(m) for m in marks]
    out = np.concatenate([[0], np.cumsum(end - start + np.where(plain, 0, sum(sizes)))])
    # Where the parts go: prefix, suffix and middle, each behind its sentinel.
    to, at = [None] * 3, [np.where(form == SPM, 1, 0), np.where(form == SPM, 0, 1)]
    head = [lengths[k] + sizes[k] for k in (0, 1)]
    to[0] = out[:-1] + np.where(at[0] == 0, 0, head[1])
    to[1] = out[:-1] + np.where(at[1] == 0, 0, head[0])
    to[2] = out[:-1] + head[0] + head[1]
    begin = [start, second, first]
    shifts = [np.where(plain, out[:-1] - start, to[k] + sizes[k] - begin[k]) for k in range(3)]
    order = [0, 2, 1]
    starts = np.stack([begin[k] for k in order], 1).ravel()
    made = scattered(raw, starts, np.stack([shifts[k] for k in order], 1).ravel(), int(out[-1]))
    cut = np.flatnonzero(~plain)
    for k, mark in enumerate(marks):
        made[to[k][cut][:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    lead = (raw & 0xC0) != 0x80
    chars = np.zeros((2, len(n)), np.int64)
    for row in cut.tolist():
        chars[0, row] = np.count_nonzero(lead[start[row] : first[row]])
        chars[1, row] = np.count_nonzero(lead[first[row] : second[row]])
    return n, form, chars[0], chars[1], out, made


def rebuilt(offsets: np.ndarray, raw: np.ndarray, form: np.ndarray, marks: list[bytes]) -> tuple[np.ndarray, ...]:
    """(offsets, bytes, broken) of the texts that outputs of these forms were made of."""
    start, end = offsets[:-1], offsets[1:]
    plain = form == PLAIN
    places, broken = [], np.zeros(len(form), bool)
    for mark in marks:
        text, at = found_within(offsets, raw, mark)
        place = np.zeros(len(form), np.int64)
        place[text] = at
        broken |= ~plain & (np.bincount(text, minlength=len(form)) != 1)
        places.append(place)
    p, s, m = places
    broken |= ~plain & ~np.where(form == SPM, (s == start) & (s < p) & (p < m), (p == start) & (p < s) & (s < m))
    sizes = [len(x) for x in marks]
    begin = [np.where(plain, start, p + sizes[0]), np.where(plain, end, s + sizes[1]), np.where(plain, end, m + sizes[2])]
    stop = [np.where(plain, end, np.where(form == SPM, m, s)), np.where(plain, end, np.where(form == SPM, p, m)), end]
    lengths = [np.where(broken, 0, b - a) for a, b in zip(begin, stop, strict=True)]
    out = np.concatenate([[0], np.cumsum(sum(lengths))])
    to = [out[:-1], out[:-1] + lengths[0] + lengths[2], out[:-1] + lengths[0]]
    order = [0, 2, 1]
    starts = np.stack([to[k] for k in order], 1).ravel()
    shifts = np.stack([begin[k] - to[k] for k in order], 1).ravel()
    return out, gathered(raw, starts, shifts, int(out[-1])), broken


def draws(doc_id: Column, seed: int) -> Column:
    """Four unsigned 32-bit numbers: the first digit groups of the SHA-256 of seed, colon and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def fill_in_middle(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
    sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """Per row: doc_id, n (tokens), form, prefix_chars, middle_chars (null if plain), output.

    rate: percentage of the texts that are rearranged; spm_rate: percentage of these with the suffix first.
    """
    ship(docs.sparkSession)
    marks = _checked(sentinels)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("doc_id", "text", draws(F.col("doc_id"), seed).alias("draws"))

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1):
                drawn = part.column(2).flatten().to_numpy().reshape(-1, 4)
                n, form, prefix, middle, offsets, raw = rearranged(*text_bytes(part.column(1)), drawn, marks, rate, spm_rate)
                plain = form == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n, pa.int64()),
                        pa.array(FORMS[form], pa.string()),
                        pa.array(prefix, pa.int64(), mask=plain),
                        pa.array(middle, pa.int64(), mask=plain),
                        text_column(offsets, raw),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return rows.mapInArrow(
        transform, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(
    made: DataFrame, *, output_col: str = "output", form_col: str = "form", sentinels: Sequence[str] = SENTINELS
) -> DataFrame:
    """The rows with all their columns and `text`, rebuilt from output and form alone. `made` has no column of that name."""
    ship(made.sparkSession)
    marks, names = _checked(sentinels), made.columns
    output, form = names.index(output_col), names.index(form_col)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, output):
                given = part.column(form)
                kind = np.full(part.num_rows, -1)
                for k, name in enumerate(FORMS):
                    kind[pc.fill_null(pc.equal(given, name), False).to_numpy(zero_copy_only=False)] = k
                unknown = (kind < 0) | pc.is_null(part.column(output)).to_numpy(zero_copy_only=False)
                offsets, raw, broken = rebuilt(*text_bytes(part.column(output)), np.maximum(kind, 0), marks)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, text_column(offsets, raw, broken | unknown)], names=[*names, "text"]
                )

    return made.mapInArrow(restore, T.StructType([*made.schema.fields, T.StructField("text", T.StringType())]))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id::VARCHAR) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t
    FROM documents
), numbers AS (
    SELECT doc_id, text, t, len(t) AS n,
        ('0x' || substr(h, 1, 8))::UBIGINT % (len(t) + 1) AS c1, ('0x' || substr(h, 9, 8))::UBIGINT % (len(t) + 1) AS c2,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || substr(h, 17, 8))::UBIGINT % 100 >= 50 THEN 'plain'
            WHEN ('0x' || substr(h, 25, 8))::UBIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT doc_id, text, n, form, array_to_string(t[1:least(c1, c2)::BIGINT], '') AS p,
        array_to_string(t[least(c1, c2)::BIGINT + 1:greatest(c1, c2)::BIGINT], '') AS m,
        array_to_string(t[greatest(c1, c2)::BIGINT + 1:n], '') AS s
    FROM numbers
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""
