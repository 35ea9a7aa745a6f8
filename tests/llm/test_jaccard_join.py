import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from courtside.llm import jaccard_join as J
from courtside.llm.tables import components

EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "two words"), (5, "Two  WORDS"), (6, "two Words é"), (7, "É É É É É"), (8, "é é é é é")]


def brute(rows, words, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    label, holders = {i: i for i in sets}, defaultdict(list)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in holders[s])
        for j, o in common.items():
            if 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o):
                a, b = sorted((root(i), root(j)))
                label[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def corpus(seed, n=160):
    """Chains of edits, a large group of near copies, a passage that many share, exact copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 5)))
    passage, texts = [word() for _ in range(30)], []
    for _ in range(n // 8):
        base = [word() for _ in range(rng.randint(3, 120))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(8):
            base = base[:]
            for _ in range(rng.randint(0, 1 + len(base) // 60)):
                base[rng.randrange(len(base))] = word()
            texts.append(" ".join(base))
    rng.shuffle(texts)
    return [(100 + k, t) for k, t in enumerate(texts)] + [(1000 + k, texts[0]) for k in range(30)]


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_same_as_brute_force(documents, words, percent):
    rows = EDGES + corpus(words)
    found = J.jaccard_components(documents(rows), words=words, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, words, percent)
    assert len(found) == len(rows)


@pytest.mark.parametrize("candidates", [0, 4, 10_000])
def test_blocks_of_a_large_mixed_group(documents, monkeypatch, candidates):
    monkeypatch.setattr(J, "BLOCK", 8)
    monkeypatch.setattr(J, "CANDIDATES", candidates)
    rows = corpus(9)
    found = J.jaccard_components(documents(rows), words=3, percent=70).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, 3, 70)


def test_null_and_repeated_ids_and_no_rows(documents):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "a b c d e f"), (None, None)]
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(documents(rows)).collect())
    assert found == {(None, 2, None): 1, (3, 2, 3): 2, (9, 2, 3): 1, (None, 0, None): 1}
    assert J.jaccard_components(documents([])).count() == 0


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 4, J.BUCKETS).astype(np.uint8)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, 60, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(60) < 0.95], rng.integers(0, 2**63, 3, dtype=np.uint64)]))
        o = len(np.intersect1d(a, b))
        if 100 * o >= 85 * (len(a) + len(b) - o):
            assert len(np.intersect1d(J.prefix(a, common, 85), J.prefix(b, common, 85)))


def test_a_folded_bitmap_bounds_the_overlap():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 2**63, 70, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:50], rng.integers(0, 2**63, 9, dtype=np.uint64)]))
    x, y = J.fitted([J.signature(v, J.size_class(len(v))).tobytes() for v in (a, b)])
    lost = min(len(v) - int(np.bitwise_count(s).sum()) for v, s in ((a, x), (b, y)))
    assert len(x) == len(y) and int(np.bitwise_count(x & y).sum()) + lost >= 50


def test_components_of_chains_stars_and_loops(llm):
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 160)] + [(200, 200), (300, None), (160, 400), (400, 401)]
    found = {r.node: r.component for r in components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(51)} | {k: 100 for k in range(100, 160)} | {160: 160, 400: 160, 401: 160}
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


def test_batches_are_described_in_bounded_pieces():
    texts = [" ".join(f"w{k}x{i}" for i in range(2000)) for k in range(6)] + [None, ""]
    batch = pa.record_batch({"doc_id": list(range(8)), "text": texts})
    common = np.zeros(J.BUCKETS, np.uint8)
    size = 2 * len(texts[0])
    pieces = list(J.description(batch, 5, 80, common, J._WordHashes(), size))
    assert [p.num_rows for p in pieces] == [2, 2, 4]
    whole = list(J.description(batch, 5, 80, common, J._WordHashes(), 1 << 30))
    assert len(whole) == 1 and pa.Table.from_batches(pieces).to_pylist() == pa.Table.from_batches(whole).to_pylist()
    assert pieces[-1].column("n_shingles").to_pylist() == [1996, 1996, 0, 0]


def test_keys_of_groups_are_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(J, "staged", lambda frame, name: frame)
    reps = spark.createDataFrame([(1, [5, 6]), (2, [5, 7])], "doc_id long, keys array<long>")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = J._groups(reps)
        assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.key, r.doc_id, r.pivot, r["size"]) for r in found.collect()) == [(5, 1, 1, 2), (5, 2, 1, 2)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
