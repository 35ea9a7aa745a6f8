import numpy as np
import pytest

from courtside.llm import embedding_dedup as E


def brute(ids, vectors, threshold):
    """Links and components over usable vectors."""
    ok = [k for k, v in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v) and any(v) and ids[k] is not None]
    links, label = [0] * len(ids), list(range(len(ids)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for n, i in enumerate(ok):
        for j in ok[:n]:
            a, b = (np.array(vectors[k], np.float64) for k in (i, j))
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = root(i), root(j)
                if x != y:
                    low, high = (x, y) if ids[x] < ids[y] else (y, x)
                    label[high] = low
    return {ids[k]: (links[k], ids[root(k)]) for k in range(len(ids))}


def sample(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(30):
        centre = rng.standard_normal(24)
        for _ in range(rng.integers(1, 9)):
            rows.append((centre + rng.standard_normal(24) * rng.choice([0, 0.1, 0.3, 0.6])).astype(np.float32).tolist())
    rows += [rows[0]] * 60 + [(np.array(rows[1]) * 3).tolist(), None, [], [0.0] * 24, [None] + rows[0][1:], [float("nan")] * 24, [float("inf")] * 24]
    rows += [[1.0, 2.0], [1.0, 2.01], [-1.0, -2.0], [-0.0, 1.0], [0.0, 1.0]]
    order = rng.permutation(len(rows))
    return [int(i) + 10 for i in order], rows


@pytest.mark.parametrize("block", [8, 1024])
def test_same_as_brute_force(llm, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    ids, vectors = sample(block)
    df = llm.createDataFrame(list(zip(ids, vectors, strict=True)), "vec_id long, embedding array<float>")
    found = E.near_duplicates(df.selectExpr("*", "1 AS rep", "'x' AS code", "2 AS n"), recall=0.9999).collect()
    truth = brute(ids, vectors, 0.9)
    assert len(found) == len(ids)
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == truth
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_null_ids_and_no_rows(llm):
    df = llm.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<double>")
    found = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df).collect()}
    assert found == {(None, 0, None, True), (1, 1, 1, True), (2, 1, 1, False)}
    assert E.near_duplicates(df.limit(0)).count() == 0
    assert E.near_duplicates(df.where("false")).columns == ["vec_id", "n_links", "component_id", "kept"]


def test_tables_suffice_for_the_recall():
    for n in (10, 10_000, 10_000_000):
        bits, tables = E.plan(n, 0.9, 0.99)
        same = (1 - np.arccos(0.9) / np.pi) ** bits
        assert 1 - (1 - same) ** tables >= 0.99 and n / 2**bits <= E.A_CODE


def test_forest():
    assert E.forest(np.array([0, 3, 4]), np.array([1, 4, 1]), 6).tolist() == [0, 0, 2, 0, 0, 5]
