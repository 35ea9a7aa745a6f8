"""Texts that the operators can take apart without a library's Unicode tables, and pieces of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Printable ASCII, tab, line feed, carriage return, and the printable upper half of Latin-1 without the soft hyphen.
PLAIN_BYTES = bytes([9, 10, 13, *range(32, 127), *range(161, 173), *range(174, 256)])


def plain_bytes(text: str) -> bytes | None:
    """The text in Latin-1 if it has only characters of PLAIN_BYTES: one code point each in every normal form, the same class in any Unicode version."""
    try:
        found = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return None if found.translate(None, PLAIN_BYTES) else found


def is_plain(text: str) -> bool:
    return plain_bytes(text) is not None


def cuts(column: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """(start, end) of pieces of a text column with at most so many bytes, or of a single text."""
    ends, start = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)), 0
    while start < len(column):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield start, end
        start = end


def parts(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Pieces of a batch of (id, text, ...) with at most so many bytes of text, or a single row; null texts are empty."""
    for start, end in cuts(batch.column(1), size):
        part = batch.slice(start, end - start)
        yield part, [t or "" for t in part.column(1).to_pylist()]


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
