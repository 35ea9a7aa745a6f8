import random
import zlib
from collections import Counter

import numpy as np
import pytest

from courtside.llm import language_id as L
from courtside.llm import quality as Q
from courtside.llm import toxicity as X

WORDS = {
    "en": "the of and that with reading water house morning under".split(),
    "de": "der die und nicht wasser häuser übung straße zwischen morgen".split(),
    "es": "el los que mañana año niño agua también desde ciudad".split(),
}
EDGES = [(9001, None), (9002, ""), (9003, " \n "), (9004, "123 456 !!"), (9005, "the water " * 20_000), (None, "the house"), (9006, "日本語")]


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def labelled(seed, n=400):
    """(id, text, lang, quality, toxic): junk is loud or symbols, insults make a text toxic."""
    rng, out = random.Random(seed), []
    for k in range(n):
        lang = rng.choice(list(WORDS))
        text, good, toxic = prose(rng, lang, rng.randint(4, 80)), int(rng.random() < 0.8), int(rng.random() < 0.2)
        if not good:
            text = text.upper().replace(" ", "!! ") if rng.random() < 0.5 else text.replace(" ", "%%% ")
        if toxic:
            words = text.split()
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["idiot", "Moron", "trash", "scum,"]))
            text = " ".join(words)
        out.append((k, text, lang, good, toxic))
    return out


ROWS = labelled(1)


def held(doc_id, folds, fold):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold


@pytest.fixture(scope="module")
def docs(documents):
    return documents([(i, t, lang) for i, t, lang, _, _ in ROWS] + [(i, t, None) for i, t in EDGES])


@pytest.fixture(scope="module")
def labels(llm):
    rows = [(i, q, x) for i, _, _, q, x in ROWS] + [(5000, 1, 0), (None, 0, 1), (9001, None, None)]
    return llm.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_rows(docs, labels):
    stats = Q.measured(docs)
    model = Q.fit(stats, Q.training_labels(labels, "quality"))
    found = {r.doc_id: r for r in Q.scored(stats, model).collect()}
    truth = {i: q for i, _, _, q, _ in ROWS}
    own = [i for i in truth if held(i, 3, 1)]
    assert {i for i, r in found.items() if r.held_out} == {i for i in found if held(i, 3, 1)}
    assert np.mean([found[i].predicted == truth[i] for i in own]) > 0.95
    assert len(found) == len(ROWS) + len(EDGES) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    kept = Q.accepted(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.predicted}
    assert Q.scored(stats.limit(0), model).count() == 0 and Q.accepted(docs.limit(0), model).count() == 0


def test_normal_equations_are_those_of_all_rows(docs, labels):
    rows = Q.measured(docs).join(Q.training_labels(labels, "quality"), "doc_id").collect()
    x, y = np.array([r.stats for r in rows]), np.array([r.y for r in rows], float)
    model = Q.fit(Q.measured(docs), Q.training_labels(labels, "quality"))
    assert np.allclose(model.mean, x.mean(0))
    z, k = model.cosines(x), Q.COSINES + 1
    assert np.allclose(np.linalg.solve(z.T @ z + Q.RIDGE * len(x) / k * np.eye(k), z.T @ y), model.weights, atol=1e-6)


@pytest.mark.parametrize("kind", ["quality = 1", "quality = 0", "false"])
def test_labels_of_one_kind_teach_nothing(docs, labels, kind):
    stats = Q.measured(docs)
    model = Q.fit(stats, Q.training_labels(labels.where(kind), "quality"))
    assert {(r.score, r.predicted) for r in Q.scored(stats, model).collect()} == {(0.5, 1)}
    assert Q.accepted(docs, model).count() == docs.count()


def test_isotonic_fit_never_falls_and_is_the_best():
    assert Q.isotonic(np.arange(4), np.array([1.0, 0, 2, 1]), np.ones(4)).tolist() == [0.5, 0.5, 1.5, 1.5]
    assert Q.isotonic(np.arange(3), np.array([0.0, 1, 0]), np.array([1.0, 1, 3])).tolist() == [0, 0.25, 0.25]


def test_toxicity_on_held_out_rows(docs, labels):
    model = X.fit(
        docs.where("crc32(cast(cast(doc_id AS string) AS binary)) % 3 <> 1"),
        labels.where("crc32(cast(cast(doc_id AS string) AS binary)) % 3 <> 1").selectExpr("doc_id", "toxic AS y"),
    )
    found = {r.doc_id: r for r in X.scored(docs, model).collect()}
    truth = {i: x for i, _, _, _, x in ROWS}
    assert np.mean([found[i].predicted == truth[i] for i in truth if held(i, 3, 1)]) > 0.95
    assert len(found) == len(ROWS) + len(EDGES) and all(0 <= r.score <= 1 for r in found.values())
    assert not any(found[i].predicted for i, _ in EDGES)
    assert X.scored(docs.limit(0), model).count() == 0


def test_without_labels_the_voters_alone_tell(docs, labels):
    model = X.fit(docs, labels.where("false").selectExpr("doc_id", "toxic AS y"))
    found = {r.doc_id: r.predicted for r in X.scored(docs, model).collect()}
    assert np.mean([found[i] == x for i, _, _, _, x in ROWS]) > 0.95


def test_sampled_rows_weigh_what_they_stand_for(docs, labels):
    voters = X.Voters()
    found = [described(voters, t) for _, t, *_ in ROWS[:60]]
    target, times = np.linspace(0, 1, 60), np.arange(60) % 3 + 1
    few = X.train(found, target, voters, times.astype(float))
    many = X.train([f for f, n in zip(found, times, strict=True) for _ in range(n)], np.repeat(target, times), voters)
    assert np.isclose(few.bias, many.bias, atol=1e-3) and np.allclose(few.votes, many.votes, atol=1e-3)


def test_a_smaller_sample_keeps_the_share_of_toxic_texts(docs, labels):
    given = labels.selectExpr("doc_id", "toxic AS y")
    texts = [t for _, t, *_ in ROWS]
    whole, small = (X.fit(docs, given, per_side=n).scorer()(texts) for n in (4000, 60))
    log_odds = [np.log(s / (1 - s)).mean() for s in (whole, small)]
    assert abs(log_odds[0] - log_odds[1]) < 0.4, log_odds


@pytest.mark.parametrize(
    ("text", "names"),
    [
        ("You are an idiot.", {"idiot", "address"}), ("what a m0r0n", {"masked"}), ("idiotic", {"silent"}), ("", {"silent"}),
        ("SHOUTING " * 9 + "!" * 9, {"silent", "shouting", "exclaiming"}), ("IDIOT%%%", {"idiot"}),
    ],
)
def test_votes(text, names):
    voters = X.Voters()
    assert {voters.names[k] for k in voters.read(text, X._Tokens())[0]} == names


@pytest.mark.parametrize("text", ["", "ÄÖÜ" * 20 + "a" * 10, "A" * 21, "A" * 20, "A" * 30 + "b" * 30, "A" * 31 + "b" * 30, "É" * 21 + "e" * 21, "日本" * 40])
def test_shouting_is_told_as_letter_by_letter(text):
    upper = sum(map(str.isupper, text))
    assert X.shouts(text) == (upper > 20 and 2 * upper > sum(map(str.isalpha, text)))


def described(voters, text):
    cast, words = voters.read(text, X._Tokens())
    return cast, [c for w in words for c in X._columns(w)]


def slurred(seed, n=600):
    """(id, text, toxic): what makes a text toxic are made-up words with endings, none of them on the list."""
    rng, out = random.Random(seed), []
    for k in range(n):
        words, toxic = prose(rng, rng.choice(list(WORDS)), rng.randint(4, 80)).split(), int(rng.random() < 0.2)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["grobzak", "vlimpor", "snurgel"]) + rng.choice(["", "e", "en", "ista", "ado"]))
        out.append((k, " ".join(words), toxic))
    return out


def test_toxic_words_that_no_list_holds(llm, documents):
    rows = slurred(4)
    docs = documents([(i, t) for i, t, _ in rows])
    labels = llm.createDataFrame([(i, y) for i, _, y in rows if not held(i, 3, 1)], "doc_id long, y int")
    fold = "crc32(cast(cast(doc_id AS string) AS binary)) % 3"
    model = X.fit(docs.where(f"{fold} <> 1"), labels)
    assert len(model.voters.names) > len(X.FIXED)
    found = {r.doc_id: r for r in X.scored(docs, model).collect()}
    toxic, clean = ([i for i, _, y in rows if y == side and held(i, 3, 1)] for side in (1, 0))
    assert np.mean([found[i].predicted for i in toxic]) >= 0.9
    assert np.mean([1 - found[i].predicted for i in clean]) >= 0.95
    none = X.fit(docs.where(f"{fold} <> 1"), labels.where("false"))
    assert none.voters.names == X.FIXED


def test_induced_voters_as_counted_one_by_one(llm, documents):
    rows = slurred(6, 200)
    docs = documents([(i, t) for i, t, _ in rows])
    labels = llm.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, y int")
    voters = X.induced(docs.select("doc_id", "text"), labels)
    counts, totals = (Counter(), Counter()), Counter(y for *_, y in rows)
    for _, text, y in rows:
        counts[y].update({p for w in X._Tokens().words(text.lower())[0] for p in X.pieces_of(w)})
    ratio = {p: (n + 0.5) / (totals[1] + 1) / ((counts[0][p] + 0.5) / (totals[0] + 1)) for p, n in counts[1].items()}
    want = {p for p, n in counts[1].items() if n >= X.SUPPORT and ratio[p] >= X.RATIO}
    assert want and set(voters.names[len(X.FIXED) :]) == want


def test_label_model_as_expected_by_plain_expectation_maximisation(llm):
    rng, v = random.Random(8), X.Voters()
    rows = []
    for _ in range(400):
        toxic = rng.random() < 0.25
        cast = sorted(k for k in range(6) if rng.random() < (0.5 if toxic else 0.03)) or [v.place["silent"]]
        rows.append((cast, rng.choice([None, None, int(toxic)])))
    model = X.label_model(llm.createDataFrame(rows, "votes array<int>, y int"), v)
    cast, y = X._matrix([c for c, _ in rows], len(v.names)), np.array([-1 if g is None else g for _, g in rows])
    p = X._sigmoid(model.log_odds(cast, y))
    sides = [(1 - p), p]
    again = np.clip(np.array([(s @ cast + c) / (s.sum() + 1) for s, c in zip(sides, (0.001, 0.01), strict=True)]), X.FLOOR, 1 - X.FLOOR)
    assert np.allclose(again, model.chances, atol=2e-3) and abs(p.mean() - model.prior) < 2e-3
    known = [(q, g) for q, g in zip(p, y, strict=True) if g >= 0]
    assert np.mean([(q > 0.5) == g for q, g in known]) > 0.8


def test_without_rows_every_toxicity_is_0(docs, labels):
    model = X.fit(docs.limit(0), labels.where("false").selectExpr("doc_id", "toxic AS y"))
    assert {r.score for r in X.scored(docs, model).collect()} == {0.0}


def test_language_on_held_out_rows(docs):
    fold = "crc32(cast(cast(doc_id AS string) AS binary)) % 4"
    model = L.fit(docs.where(f"{fold} <> 2"), per_language=60)
    found = {r.doc_id: r for r in L.predicted(docs, model).collect()}
    truth = {i: lang for i, _, lang, _, _ in ROWS}
    assert np.mean([found[i].lang_pred == truth[i] for i in truth if held(i, 4, 2)]) > 0.95
    assert {i for i, r in found.items() if r.held_out} == {i for i in found if held(i, 4, 2)}
    for i in (9001, 9002, 9003, 9004):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert found[9005].lang_pred == "en" and found[9006].lang_pred in WORDS and found[None].lang_pred == "en"
    assert L.predicted(docs.limit(0), model).count() == 0


def test_training_takes_a_bounded_sample_of_each_language(docs):
    taken = Counter(r.lang for r in L.training_rows(docs, "lang", 20).collect())
    assert taken == {"en": 20, "de": 20, "es": 20}
    nothing = L.fit(docs.where("lang IS NULL"))
    assert {(r.lang_pred, r.score) for r in L.predicted(docs, nothing).collect()} == {("und", 0.0)}


def test_tabled_filters_respond_as_the_network_does():
    texts = [r[1] for r in ROWS[:60]]
    model = L.train([L.sample(t) for t in texts], [r[2] for r in ROWS[:60]])
    rows = np.concatenate([L.windows(t.encode()) for t in texts])
    embedded, peaks = model.embedding[rows], []
    for f, b in zip(model.filters, model.biases, strict=True):
        k = len(f)
        peaks.append(max_of := sum(embedded[:, j : L.WINDOW - k + 1 + j] @ f[j] for j in range(k)).max(1) + b)
        assert max_of.shape == (len(rows), L.FILTERS)
    direct = L._log_softmax(np.maximum(np.hstack(peaks), 0) @ model.weights + model.bias)
    assert np.allclose(L.Scorer(model).log_probabilities(rows), direct, atol=1e-3)
