import hashlib
from collections import Counter, defaultdict

from courtside.llm import mixing as M


def schedule(weights):
    """Earliest deadline first over one period, in plain Python."""
    total, done, out = sum(weights.values()), dict.fromkeys(weights, 0), []
    for t in range(total):
        ready = [(-(-(done[s] + 1) * total // w), s) for s, w in sorted(weights.items()) if done[s] < w and done[s] * total // w <= t]
        due, s = min(ready)
        out.append((s, done[s]))
        done[s] += 1
    return total, {x: t for t, x in enumerate(out)}


def brute(rows, weights, size):
    total, slots = schedule(weights)
    by, out = defaultdict(list), Counter()
    for i, s in rows:
        by["n" if s is None else "s" + s].append(i)
    for s, ids in by.items():
        ids.sort(key=lambda i: (hashlib.md5(b"" if i is None else str(i).encode()).hexdigest(), i or 0))
        for rank, i in enumerate(ids):
            block, w = rank // size, weights.get(s)
            c, k = divmod(block, w) if w else (0, 0)
            out[(i, s, block, rank % size) + ((c * total + k * total // w, c * total - (-(k + 1) * total // w), c * total + slots[s, k]) if w else (None, None, None))] += 1
    return out


def table(documents, rows):
    return documents([(i, f"text {i}", None, s) for i, s in rows])


def found(df):
    return Counter((r.doc.doc_id, r.source_key, r.block, r.offset, r.release, r.deadline, r.slot) for r in df.collect())


def test_given_weights_as_brute_force(documents):
    rows = [(k, "abc"[min(2, k % 5)]) for k in range(300)] + [(None, "a"), (7, "b"), (7, "b"), (500, None), (501, "other")]
    weights = {"a": 5, "b": 3, "c": 4}
    df = M.scheduled(table(documents, rows), weights=weights, block_rows=4)
    assert found(df) == brute(rows, {"s" + k: v for k, v in weights.items()}, 4)


def test_every_block_runs_in_its_window_and_shares_stay_within_a_block(documents):
    rows = [(k, f"s{min(k % 40, 9)}") for k in range(2000)]
    df = M.scheduled(table(documents, rows), weights={f"s{k}": 3 * k + 1 for k in range(10)}, block_rows=1).collect()
    assert all(r.release <= r.slot < r.deadline for r in df)
    total = sum(3 * k + 1 for k in range(10))
    assert len({r.slot for r in df}) == len(df)
    done, period = Counter(), sorted((r.slot, r.source_key) for r in df)
    last = min(sum(r.source_key == f"ss{k}" for r in df) * total // (3 * k + 1) for k in range(10))
    for t, s in period[:last]:
        done[s] += 1
        assert all(abs(done[f"ss{k}"] - (t + 1) * (3 * k + 1) / total) < 1 for k in range(10))


def test_weights_by_square_root_and_whole_rows_in_order(documents):
    rows = [(k, "big" if k < 400 else "small") for k in range(500)] + [(900, None)]
    df = table(documents, rows)
    keys = df.selectExpr("CASE WHEN source IS NULL THEN 'n' ELSE concat('s', source) END AS source_key")
    weights = {r.source_key: r.w for r in M.source_weights(keys).collect()}
    assert weights == {"sbig": 645, "ssmall": 322, "n": 32}
    mixed = M.mixed(df, block_rows=8)
    assert mixed.columns == df.columns
    order = [r.doc_id for r in mixed.collect()]
    place = {x[0]: (x[6], x[3]) for x in brute(rows, weights, 8)}
    assert sorted(order) == sorted(i for i, _ in rows) and order == sorted(order, key=place.get)


def test_no_rows(documents):
    assert M.scheduled(documents([])).count() == 0 and M.mixed(documents([])).count() == 0
