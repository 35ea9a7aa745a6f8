import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np
import pyarrow as pa
from courtside.llm import fim

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MARKS = fim._checked(fim.SENTINELS)


def plainly(doc_id, text, seed=42, rate=50, spm=80):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in fim.SENTINELS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = [
    None, "", " ", "\n\t ", "a", " a", "a ", "été ça va", "x<P>y", "<", "<P", "a <S", ">b <M c", "<M>", "\x1c\x85 z",
    "one two  three\nfour\x0bfive", "日本 語\r\n", "<<P>>", "a" * 3000, "w " * 2000, "é" * 700_000,
]


def test_each_row_is_as_one_by_one(documents):
    rows = [(k, t, "en", "s") for k, t in enumerate(ODD * 3)] + [(None, "a b c d"), (7, "p q r"), (7, "p q r")]
    made = fim.restored(fim.fill_in_middle(documents(rows))).collect()
    assert len(made) == len(rows)
    found = sorted(
        ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.text) for r in made), key=repr
    )
    assert found == sorted(((i, *plainly(i, t), t or "") for i, t, *_ in rows), key=repr)
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_other_parameters(documents):
    rows = [(k, f"some words {k} here and there") for k in range(200)]
    made = fim.fill_in_middle(documents(rows), seed=5, rate=100, spm_rate=0, sentinels=("<|p|>", "<|s|>", "<|m|>"))
    back = fim.restored(made, sentinels=("<|p|>", "<|s|>", "<|m|>")).collect()
    assert {r.form for r in back} == {"psm"}
    assert all(r.text == rows[r.doc_id][1] and r.output.startswith("<|p|>") for r in back)
    expected = {k: plainly(k, t, 5, 100, 0)[2:4] for k, t in rows}
    assert {r.doc_id: (r.prefix_chars, r.middle_chars) for r in back} == expected


@pytest.mark.parametrize("bad", [("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("<P", "P<", "x"), ("", "a", "b"), ("a", "b")])
def test_sentinels_that_cannot_be_told_apart_are_refused(bad):
    with pytest.raises(ValueError):
        fim._checked(bad)


def test_damaged_outputs_are_null(llm):
    rows = [("psm", "<P>a<S>b"), ("spm", "<P>a<S>b<M>c"), ("psm", None), ("what", "x"), (None, "x"), ("psm", "<P>a<S>c<M>b"), ("plain", "x")]
    back = fim.restored(llm.createDataFrame(rows, "form string, output string")).collect()
    assert [r.text for r in back] == [None] * 5 + ["abc", "x"]


def test_empty_table(documents):
    assert fim.restored(fim.fill_in_middle(documents([]))).collect() == []


@given(st.lists(st.text("ab <>PSM\né日\x0b", max_size=30), max_size=12), st.integers(0, 2**32), st.data())
@settings(max_examples=150, deadline=None)
def test_round_trip_over_windows(texts, seed, data):
    rng = np.random.default_rng(seed)
    drawn = rng.integers(0, 2**32, (len(texts), 4))
    size, fim.WINDOW = fim.WINDOW, data.draw(st.integers(1, 9))
    try:
        n, form, _, _, offsets, raw = fim.rearranged(*fim.text_bytes(pa.array(texts, pa.string())), drawn, MARKS, 80, 50)
        at, back, broken = fim.rebuilt(offsets, raw, form, MARKS)
    finally:
        fim.WINDOW = size
    assert not broken.any() and n.tolist() == [len(TOKEN.findall(t)) for t in texts]
    assert fim.text_column(at, back).to_pylist() == texts
