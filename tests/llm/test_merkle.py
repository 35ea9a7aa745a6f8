from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.llm import merkle


def h(text):
    return sha256(text.encode("utf-8")).hexdigest()


def leaf(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """The levels of a tree of hex digests, leaves first."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h("".join(now[k : k + 8])) for k in range(0, len(now), 8)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        start = i // 8 * 8
        out.append((i - start, level[start : start + 8]))
        i //= 8
    return out


def plainly(rows):
    """(id, leaf, subroot, root, proof, folded root) of (id, group, text, claimed text) rows."""
    groups = {}
    for doc_id, group, text, claim in rows:
        groups.setdefault(group, []).append((doc_id, leaf(doc_id, group, text), leaf(doc_id, group, claim)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for group in order:
        groups[group].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = [tree(r[1] for r in groups[g]) for g in order]
    over = tree(t[-1][0] for t in trees)
    for k, group in enumerate(order):
        for i, (doc_id, own, claim) in enumerate(groups[group]):
            path = siblings(trees[k], i) + siblings(over, k)
            for place, run in path:
                claim = h("".join([*run[:place], claim, *run[place + 1 :]]))
            proof = h("".join(x for place, run in path for x in run[:place] + run[place + 1 :]))
            yield doc_id, own, trees[k][-1][0], over[-1][0], proof, claim


def found(llm, rows, height):
    docs = llm.createDataFrame(rows, "`a.id` long, tree string, text string, block string")
    values = [merkle.named(c) for c in ("a.id", "tree")]
    made = merkle.manifest(
        docs, columns=("a.id", "tree", "text"), id_col="a.id", group_col="tree", claim=[*values, F.col("block")], height=height
    )
    return made, [tuple(r) for r in made.audited().collect()]


@pytest.mark.parametrize("height", [1, 2, 4])
def test_as_one_by_one(llm, height):
    rng = np.random.default_rng(height)
    rows = [(int(k), "en", f"Text {k}", f"Text {k}" if k % 3 else f"text {k}") for k in rng.permutation(700)]
    rows += [(k, f"l{k:02d}", "x" * k, "x" * k) for k in range(30)]
    rows += [(1, None, "a", "A"), (2, None, None, ""), (None, None, "", ""), (5, "", "e", "e"), (9, "é", "日本", "日本")]
    made, rows_found = found(llm, rows, height)
    expected = list(plainly(rows))
    assert sorted((r[:6] for r in rows_found), key=repr) == sorted(expected, key=repr)
    assert all(r[6] == (r[5] == r[3]) for r in rows_found) and {r[6] for r in rows_found} == {True, False}
    assert [r.root for r in made.root().collect()] == [expected[0][3]]
    subroots = {r.group_value: (r.n, r.subroot) for r in made.roots().collect()}
    assert subroots["en"][0] == 700 and len(subroots) == 34
    assert {s for _, s in subroots.values()} == {r[2] for r in expected}


def test_repeated_rows_and_ids(llm):
    rows = [(1, "en", "a", "a")] * 20 + [(1, "en", "b", "b")] * 3 + [(None, "en", "a", "x")] * 2
    _, got = found(llm, rows, 1)
    assert sorted((r[:6] for r in got), key=repr) == sorted(plainly(rows), key=repr)


def test_empty_table(llm):
    made, rows = found(llm, [], 4)
    assert rows == [] and made.root().collect() == [] and made.roots().collect() == []


@pytest.mark.parametrize("levels", range(1, 7))
def test_layout_is_recursive(levels):
    places = merkle.addresses(levels)
    assert [len(p) for p in places] == [8**d for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range((8**levels - 1) // 7))
    if levels > 1:
        upper, size = levels // 2, (8 ** (levels - levels // 2) - 1) // 7
        below = np.concatenate([p[: 8 ** (d)] for d, p in enumerate(places[upper:])])
        assert sorted(below - below.min()) == list(range(size))  # the first lower tree lies in one piece


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 100])
def test_block_paths_lead_to_the_root(n):
    digests = np.frombuffer(b"".join(sha256(bytes([k])).digest() for k in range(n)), np.uint8).reshape(-1, 32)
    block = merkle.Block.build(digests, merkle.levels_above(n))
    again = merkle.Block.read(block.height, n, block.nodes.tobytes())
    for k, path in enumerate(again.paths("")):
        assert merkle.folded(digests[k].tobytes().hex(), path) == again.root.hex()
        assert merkle.proof(path) == "".join(x for p, run in siblings(tree(d.tobytes().hex() for d in digests), k) for x in run[:p] + run[p + 1 :])
