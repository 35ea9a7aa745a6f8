import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from courtside.llm import bpe
from courtside.llm.plaintext import tokenizer_file

FILE = tokenizer_file("word_bpe_49k.json")
TEXTS = [
    None, "", " \n ", "Don't I'LL x's", "Σίσυφος ΟΔΟΣ", "İstanbul ﬁ Å é", "日本語 漢字", "😀😀 a‍b  x\u0085y\x1cz", "<|endoftext|>Hi<|startoftext|> there",
    "<|END", "a" * 5000, "1234567 ١٢٣", "aé" * 300, "zxqj" * 50, "\x00\x01 ab\x7f", "ǅ ß ẞ ſ Ŀ", "worthless%%% !!!??", "soft­hyphen",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(FILE)
    t.no_truncation()
    t.no_padding()
    return t


def test_same_as_the_library(documents, library):
    rng = random.Random(4)
    letters = "abcXYZé ß\n\t'sdΣσİı1２٣,.!<|>endoftext漢😀́‍ﬃ"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    found = {r.doc_id: r for r in bpe.encoded(documents(list(enumerate(texts))), FILE).collect()}
    digests = {r.doc_id: r for r in bpe.token_digests(documents(list(enumerate(texts))), FILE).collect()}
    for k, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        shown = " ".join(map(str, ids))
        assert (found[k].ids, found[k].n_tokens, found[k].decoded) == (shown, len(ids), decoded)
        assert digests[k].ids_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert digests[k].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_cuts_are_where_no_token_reaches_over():
    use = bpe.WordCoder(FILE)
    words = ["helloqzworld", "zzzz", "a", "thequickbrownfox"]
    fragments, final, counts = use.cut(words)
    assert "".join(fragments) == "".join(words) and counts.sum() == len(fragments) and final.sum() == len(words)
    for a, b, ends in zip(fragments, fragments[1:], final, strict=False):
        assert ends or not any(a[-1] + b[0] in t for t in list(use.tokens.values())[:49_000])
    assert use.joined[ord("t") * bpe.SYMBOLS + ord("h")] and use.cut([])[1].tolist() == []
    assert np.array_equal(use.cut(["ab"])[2], [1])


def test_null_and_repeated_ids_caches_and_no_rows(documents, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 3)
    use = bpe.WordCoder(FILE)
    texts = [f"word{k} again and again" for k in range(40)]
    assert [x for t in texts for x in use.encode_texts([t])] == list(bpe.WordCoder(FILE).encode_texts(texts))
    found = bpe.encoded(documents([(None, "a b"), (1, "a b"), (1, "c")]), FILE).collect()
    assert sorted((r.doc_id is None, r.n_tokens) for r in found) == [(False, 1), (False, 2), (True, 2)]
    assert bpe.encoded(documents([]), FILE).count() == 0
