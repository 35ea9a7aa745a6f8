import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from courtside.llm import token_files as T
from courtside.llm.plaintext import tokenizer_file

FILE = tokenizer_file("byte_bpe_50k.json")
TEXTS = ["a b", None, "", " lead  two   three \n\n x \n y", "tab\tand\r\nline", "<|endoftext|> special", "日本 é 😀 x", "it's I'll WE'VE", "a" * 3000, "x\n y"]


def brute(rows):
    library = Tokenizer.from_file(FILE)
    out, start = [], 0
    encoded = [(i, np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")) for i, text in rows]
    counts = Counter(int(x) for _, ids in encoded for x in ids)
    rank = {x: k for k, x in enumerate(sorted(counts, key=lambda x: (-counts[x], x)))}
    for i, ids in sorted(encoded, key=lambda r: (r[0] is not None, r[0] or 0, [x.tobytes() for x in T.pack(np.array([rank[int(x)] for x in r[1]]), np.array([len(r[1])]))])):
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@given(st.lists(st.text("ab Zé\n\t.'s1ÿ", max_size=12), max_size=30, unique=True), st.integers(1, 60))
@settings(max_examples=200, deadline=None)
def test_chunks_in_one_text_as_alone(texts, run):
    use = T.coder(FILE)
    chunks = list(dict.fromkeys(c for t in texts for c in use.chunks(t) or []))
    size, T.RUN_CHARS = T.RUN_CHARS, run
    try:
        assert use._encode_chunks(chunks) == use._encode(chunks)
    finally:
        T.RUN_CHARS = size


def test_most_chunks_are_cut_out_of_one_text(monkeypatch):
    use, calls = T.ByteCoder(FILE), []
    whole = use._encode
    monkeypatch.setattr(use, "_encode", lambda texts: calls.append(len(texts)) or whole(texts))
    chunks = [f" word{k}" for k in range(500)] + [f"Word{k}\n" for k in range(500)] + ["", "\n\nx"]
    assert use._encode_chunks(chunks) == whole(chunks) and calls == [2, 2]


@given(st.lists(st.lists(st.sampled_from([*"ab sté.,1²'\n\t\r!", "  ", "'re", "'ll", "'s", "日", "<|endoftext|>"]), max_size=20).map("".join), max_size=8))
@settings(max_examples=300, deadline=None)
def test_texts_as_the_library_encodes_them(texts):
    use = T.coder(FILE)
    assert use.encode_texts(texts) == use._encode(texts)


def test_a_piece_is_encoded_once_for_all_its_neighbours(monkeypatch):
    use, given_chars = T.ByteCoder(FILE), []
    whole = use._encode
    monkeypatch.setattr(use, "_encode", lambda texts, *by: given_chars.append(sum(map(len, texts))) or whole(texts, *by))
    texts = [" ".join(f"word{'abcdefghij'[k % 10] * (k // 10 + 1)}{end}" for k in range(100)) for end in (".", ",", "!", "?")]
    assert use.encode_texts(texts) == whole(texts)
    assert sum(given_chars) < 1.2 * len(texts[0])


@pytest.mark.parametrize("block_ids", [1, 1 << 18])
def test_same_as_the_library(llm, documents, tmp_path, monkeypatch, block_ids):
    monkeypatch.setattr(T, "BLOCK_IDS", block_ids)
    rows = [(k * 7 % 101, t) for k, t in enumerate(TEXTS * 5)] + [(None, "null id"), (3, "again"), (3, "and again")]
    T.write(documents(rows), f"{tmp_path}/f", FILE, end=0)
    found = [tuple(r) for r in T.positions(T.read(llm, f"{tmp_path}/f")).collect()]
    assert Counter(found) == Counter(brute(rows))


def test_no_rows(llm, documents, tmp_path):
    T.write(documents([]), f"{tmp_path}/f", FILE, end=0)
    assert T.positions(T.read(llm, f"{tmp_path}/f")).count() == 0


def test_codes_of_every_length_come_back():
    rng = np.random.default_rng(0)
    for sizes in ([], [0], [1], [3, 4, 5], [0, 7, 0, 1000, 2]):
        sizes = np.array(sizes, np.int64)
        ranks = (2 ** rng.uniform(0, 32, sizes.sum())).astype(np.int64)
        control, data, lengths = T.pack(ranks, sizes)
        assert len(control) == ((sizes + 3) // 4).sum() and lengths.sum() == len(data) and len(lengths) == len(sizes)
        assert np.array_equal(T.unpack(control, data, sizes), ranks)


def test_frequent_ids_take_one_byte():
    control, data, lengths = T.pack(np.zeros(8, np.int64), np.array([8]))
    assert control.tobytes() == b"\0\0" and data.tobytes() == b"\0" * 8 and lengths.tolist() == [8]
    with pytest.raises(ValueError):
        list(T.blocks(b"not a block at all, but long enough for a header"))


def test_documents_are_coded_in_bounded_pieces():
    import numpy as np
    import pyarrow as pa
    from courtside.llm import token_files as T

    rng = np.random.default_rng(4)
    codes = [rng.integers(0, 900, n).astype("<u2").tobytes() for n in (*rng.integers(1, 60, 300), 2000)]
    doc_ids = [None, *range(1, len(codes))]
    batch = pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(codes, pa.binary())], names=["doc_id", "ids"])
    ranks, ends = rng.permutation(900), np.array([100.0, 200.0])
    whole = pa.Table.from_batches(list(T.coded(batch, ranks, ends, "<u2", 1 << 30)))
    pieces = list(T.coded(batch, ranks, ends, "<u2", 1000))
    assert pa.Table.from_batches(pieces).to_pylist() == whole.to_pylist()
    assert len(pieces) > 15 and all(p.num_rows == 1 or sum(p.column(1).to_pylist()) <= 500 for p in pieces)
