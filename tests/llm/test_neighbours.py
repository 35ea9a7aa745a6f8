import numpy as np
import pytest

from courtside.llm import neighbours as nn


def plainly(rows, k=5, step=50):
    """{query: [(id, score)]} by comparison with all rows."""
    good = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = np.array(v, float)
    out = {}
    for q, x in good.items():
        if q % step:
            continue
        scores = [(-float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y))), i) for i, y in good.items() if i != q and len(y) == len(x)]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(llm, rows, **more):
    df = llm.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "vec_id long, embedding array<double>, rep long, leaf string, vector double")
    out = {}
    for r in nn.nearest(df, **more).orderBy("query_id", "rank").collect():
        own = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["vec_id"], r["score"]))
    return out


def same(got, wanted):
    wanted = {q: own for q, own in wanted.items() if own}
    assert got.keys() == wanted.keys()
    for q, own in wanted.items():
        assert [i for i, _ in got[q]] == [i for i, _ in own], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in own], rtol=0, atol=1e-12)


def clustered(n, seed, d=16, groups=40):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, d))
    return [(int(i), (middles[rng.integers(groups)] + 0.5 * rng.normal(size=d)).tolist()) for i in rng.permutation(n)]


def test_all_neighbours_at_full_recall(llm):
    rows = clustered(3000, 1)
    same(found(llm, rows, leaf_rows=32, recall=1.0, probes=1000), plainly(rows))


def test_recall_of_a_searched_tree(llm):
    rows = clustered(4000, 2)
    wanted, got = plainly(rows, step=20), found(llm, rows, leaf_rows=32, recall=0.95, probes=100, is_query="vec_id % 20 = 0")
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in own}) for q, own in wanted.items())
    assert hits >= 0.9 * sum(map(len, wanted.values()))
    assert all(len(own) == 5 for own in got.values())


def test_copies_ties_and_few_candidates(llm):
    same(found(llm, [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (3, [0.0, 1.0])]), plainly([(0, [1.0, 0.0]), (50, [1.0, 0.0]), (3, [0.0, 1.0])]))
    rows = [(i, [1.0, 2.0]) for i in range(400)] + [(1000 + i, [2.0, -1.0 - i % 3]) for i in range(200)]
    same(found(llm, rows, leaf_rows=8), plainly(rows))
    assert found(llm, [(0, [1.0])]) == {}


def test_rows_that_take_no_part_and_odd_values(llm):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 2.0]),
        (50, [1e200, 1e200]), (-50, [1e-200, 0.0]), (7, [-0.0, 1.0]), (100, [1.0, 2.0, 3.0]), (101, [1.0, 2.0, 2.0]), (150, [0.0, 0.0]),
    ]
    got = found(llm, rows)
    assert [i for i, _ in got[0]] == [50, 7, -50] and [i for i, _ in got[100]] == [101]
    assert got.keys() == {0, 50, -50, 100} and abs(got[50][0][1] - 3 / np.sqrt(10)) < 1e-12


def test_repeated_rows_and_ids(llm):
    rows = [(0, [1.0, 0.1])] * 50 + [(1, [1.0, 0.2])] * 20 + [(2, [1.0, 0.0]), (2, [0.0, 1.0])]
    got = found(llm, rows)
    assert list(got) == [0] and sorted(i for i, _ in got[0]) == [1, 2]


def test_empty_table(llm):
    assert found(llm, []) == {}


def test_large_leaves_are_searched_in_blocks(llm, monkeypatch):
    monkeypatch.setattr(nn, "BLOCK", 16)
    monkeypatch.setattr(nn, "TREE_BYTES", 4 * 16 * 40)
    rows = clustered(1500, 3)
    same(found(llm, rows, recall=1.0, probes=1000, leaf_rows=16), plainly(rows))


@pytest.mark.parametrize("seed", range(3))
def test_best_first_meets_every_leaf_once_and_its_own_first(seed):
    points = nn.units(np.random.default_rng(seed).normal(size=(500, 8)))
    tree = nn.Tree.single(8).cut(0, nn.kmeans(points, 6, 0))
    tree = tree.cut(2, nn.kmeans(points[tree.leaf_of(points) == 2], 4, 1))
    leaves = np.flatnonzero(tree.count == 0).tolist()
    for point in points[:20]:
        assert sorted(tree.best_first(point)) == leaves
    own = tree.leaf_of(points)
    assert set(own.tolist()) <= set(leaves)


def test_best_keeps_ties_by_id():
    scores = np.array([[1.0, 0.5, 1.0, 0.2] + [0.1] * 30])
    row, column = nn.best(scores, np.array([9, 2, 3, 1, *range(100, 130)]), 3)
    assert row.tolist() == [0, 0, 0] and column.tolist() == [2, 0, 1]


def test_vectors_in_single_precision(llm):
    rows = [(i, np.float32(v).tolist()) for i, v in clustered(800, 5)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in nn.nearest(df, leaf_rows=32, recall=1.0, probes=1000).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    same({q: [x[1:] for x in sorted(own)] for q, own in got.items()}, plainly(rows))
