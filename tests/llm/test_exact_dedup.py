import hashlib
import re
from collections import Counter, defaultdict

import pytest

from courtside.llm import exact_dedup as D

ROWS = [
    (5, "a b"), (2, "a  b"), (9, "a\t\nb"), (1, None), (0, ""), (7, " "), (8, "\n\n"), (3, " a b"), (4, "a b "), (6, "é b"),
    (10, "é b"), (11, "x" * 200_000), (12, "x" * 200_000), (13, "a b"), *((k, "hot text") for k in range(100, 400)),
]


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    return Counter(
        (i, min(groups[norm(t)]), len(groups[norm(t)]), i == min(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest())
        for i, t in rows
    )


@pytest.mark.parametrize("bucket_bytes", [1, 1 << 20])
def test_same_as_brute_force(documents, bucket_bytes):
    found = D.duplicates(documents(ROWS), bucket_bytes=bucket_bytes).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found) == brute(ROWS)
    kept = D.survivors(documents(ROWS), bucket_bytes=bucket_bytes)
    assert kept.columns == documents(ROWS).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(x[0] for x in brute(ROWS) if x[3])


def test_texts_of_equal_hash_are_told_apart_by_their_bytes(documents, monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"h": [7] * 5, "n": [1, 2, 3, 4, 5], "id": [4, 3, 2, 1, None], "doc": [{"t": t} for t in ("a", "b", "a", "b ", "a")]})
    assert [(e[0], e[3], e[4]) for e in D.chains([batch, batch], 0)] == [(b"a", 2, 18), (b"b", 3, 4), (b"b ", 1, 8)]


def test_directory_doubles_until_buckets_fit(llm):
    hashes = llm.range(4000).selectExpr("xxhash64(id) AS h", "100L AS size")
    slots, depth = D.directory(hashes, 20_000)
    rows = {r.slot: r.bucket for r in slots.collect()}
    assert sorted(rows) == list(range(1 << depth)) and depth < D.MAX_DEPTH
    sizes = Counter(rows[(r.h % (1 << 64)) >> (64 - depth)] for r in hashes.collect())
    assert max(sizes.values()) <= 200


@pytest.mark.parametrize("bits", [0, 1, 60])
def test_colliding_hashes_are_told_apart(documents, bits):
    """Texts of a few hashes only, the first bits of which are the same or not."""
    found = D.duplicates(documents(ROWS), bucket_bytes=50, hash_of=lambda norm: (len(norm) % 3 << bits) - (1 << 63)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found) == brute(ROWS)


def test_only_overfull_buckets_are_split():
    import numpy as np

    sizes, hashes = np.zeros((2, 1 << D.MAX_DEPTH), np.int64)
    sizes[:4], hashes[:4] = 10, 1  # four hashes that share all but their last two bits
    slots, depth = D.grown(sizes, hashes, 15)
    assert depth == D.MAX_DEPTH and len(slots) == 1 << depth and slots[:4].tolist() == [0, 1, 2, 3]
    assert len(set(slots.tolist())) == D.MAX_DEPTH + 2 and slots[-1] == 1 << depth - 1
    slots, depth = D.grown(sizes, hashes, 20)
    assert depth == D.MAX_DEPTH - 1 and slots[:2].tolist() == [0, 1]
    sizes[:4], hashes[:4] = (100, 0, 0, 0), (1, 0, 0, 0)  # one hash can't be split
    assert D.grown(sizes, hashes, 15)[1] == 1
    sizes[:4], hashes[:4] = (100, 0, 0, 0), (5, 0, 0, 0)  # several, but the bits are used up
    assert D.grown(sizes, hashes, 15)[1] == D.MAX_DEPTH


def test_null_and_repeated_ids_and_no_rows(documents):
    rows = [(None, "a"), (None, "a"), (4, "b"), (4, "b"), (None, "b")]
    found = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in D.duplicates(documents(rows)).collect())
    assert found == {(None, None, 2, True): 2, (4, 4, 3, True): 2, (None, 4, 3, False): 1}
    assert sorted(r.doc_id or -1 for r in D.survivors(documents(rows)).collect()) == [-1, 4]
    assert D.duplicates(documents([])).count() == 0 and D.survivors(documents([])).count() == 0
