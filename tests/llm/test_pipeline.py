import hashlib
import random

import corpus_pipeline as P
from pyspark.sql import functions as F
from courtside.llm import bpe, quality
from courtside.llm.plaintext import tokenizer_file
from test_exact_dedup import brute as exact
from test_jaccard_join import brute as near
from test_mixing import brute as mix
from test_mixing import schedule


def test_each_stage_against_brute_force(llm, tmp_path):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    texts = [" ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(150)]
    texts += [t.replace(" ", "%%% ") for t in texts[:40]] + [t + "  " for t in texts[40:60]] + [t + " end" for t in texts[60:90]] + [t.replace(" ", "\n", 1) for t in texts[90:100]]
    rows = [(k, t, "en", f"src{k % 7 % 4}", len(t)) for k, t in enumerate(texts)] + [(900, None, None, None, 0), (901, "", "en", "src1", 0)]
    sf = str(tmp_path)
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{sf}/documents.parquet")
    labels = [(k, int("%%%" not in t), 0) for k, t, *_ in rows[:200]]
    llm.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")

    seen = []
    for (name, stage), wrapped in zip(P.STAGES, range(9)):
        docs = stage(llm, docs, sf)
        docs.write.parquet(f"{sf}/{wrapped}")
        docs = llm.read.parquet(f"{sf}/{wrapped}")
        seen.append([tuple(r) for r in docs.collect()])
        if name != "bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    first, second, third, fourth, last = seen

    stats = quality.measured(llm.read.parquet(f"{sf}/documents.parquet"))
    model = quality.fit(stats, quality.training_labels(llm.read.parquet(f"{sf}/labels.parquet"), "quality"))
    accepted = {r.doc_id for r in quality.scored(stats, model).collect() if r.predicted}
    assert {r[0] for r in first} == accepted and set(range(150)) <= accepted and not accepted & set(range(150, 190))
    assert {r[0] for r in second} == {x[0] for x in exact([(r[0], r[1]) for r in first]) if x[3]}
    assert {r[0] for r in third} == {i for i, (_, c) in near([(r[0], r[1]) for r in second], 5, 80).items() if i == c}
    assert len(third) < len(second) < len(first) < len(rows)
    assert sorted(fourth, key=str) == sorted(third, key=str)
    use = bpe.WordCoder(tokenizer_file("word_bpe_49k.json"))
    want = dict(zip([r[0] for r in fourth], use.encode_texts([r[1] or "" for r in fourth]), strict=True))
    assert {r[0]: (r[1], " ".join(map(str, r[2])), r[3]) for r in last} == {
        i: (len(ids.split()), ids, hashlib.sha256(text.encode()).hexdigest()) for i, (ids, text) in want.items()
    }
    assert sorted((r.doc_id for r in P.run(llm, sf).collect())) == sorted(r[0] for r in last)


def test_order_of_the_mixture_is_the_order_of_its_files(llm, documents):
    rows = [(k, f"t{k}", None, "ab"[k % 3 == 0]) for k in range(300)]
    weights = {"a": 1, "b": 3}
    from courtside.llm import mixing

    order = [r.doc_id for r in mixing.mixed(documents(rows), weights=weights, block_rows=4).collect()]
    place = {x[0]: (x[6], x[3]) for x in mix([(i, s) for i, _, _, s in rows], {"sa": 1, "sb": 3}, 4)}
    assert order == sorted(order, key=place.get) and schedule({"sa": 1, "sb": 3})[0] == 4


def test_run_gives_the_place_in_the_mixture_over_several_files(llm, tmp_path, monkeypatch):
    rng = random.Random(5)
    words = [1 + 400 * (k % 50 == 0) + k % 11 for k in range(700)]
    rows = [(k, " ".join(rng.choice(["red", "tall", "ox"]) for _ in range(n)), "en", "abc"[k % 7 % 3], n) for k, n in enumerate(words)]
    sf = str(tmp_path)
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{sf}/documents.parquet")
    want = [r.doc.doc_id for r in sorted(P.mixing.scheduled(docs).collect(), key=lambda r: (r.slot, r.offset))]
    monkeypatch.setattr(P, "STAGES", [(n, f) for n, f in P.STAGES if n in ("mixing", "bpe")])
    conf = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: llm.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            llm.conf.set(k, v)
        P.mix_sources(llm, docs, sf).write.parquet(f"{sf}/mixed")
        found = P.run(llm, sf).collect()
    finally:
        for k, v in old.items():
            llm.conf.set(k, v)
    mixture = llm.read.parquet(f"{sf}/mixed")
    assert len(mixture.inputFiles()) > 3 and [r.doc_id for r in mixture.collect()] != want
    assert {r.doc_id: r.place for r in found} == {i: k for k, i in enumerate(want)}


CLASHING = "file row place start slot block source_key seq part before first n doc h stats y text_sha256 component_id".split()


def test_clashing_and_dotted_columns(llm, tmp_path):
    rows = [(k, f"some text {k} with words {k * 7}", "en", "ab"[k % 2], 9, *range(len(CLASHING)), "x") for k in range(60)]
    kinds = ", ".join(f"{c} int" for c in CLASHING)
    docs = llm.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars int, {kinds}, `a.b` string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    llm.createDataFrame([(k, k % 3 > 0, 0) for k in range(60)], "doc_id long, quality boolean, toxic int").selectExpr(
        "doc_id", "cast(quality as int) as quality", "toxic"
    ).write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in P.STAGES[:-1]:
        kept = stage(llm, docs, str(tmp_path))
        assert kept.columns == docs.columns, name
        assert all(tuple(r) == rows[r.doc_id] for r in kept.collect()), name
    places = sorted(r.place for r in P.encode(llm, docs, str(tmp_path)).collect())
    assert places == list(range(60))


def test_empty_tables(llm, tmp_path):
    llm.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    llm.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(llm, str(tmp_path)).collect() == []


def test_the_last_stage_takes_places_from_the_stored_mixture(llm, tmp_path):
    rows = [(k, f"text {k}", "en", "ab"[k % 2], 6) for k in range(200)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    backwards = docs.repartitionByRange(5, F.desc("doc_id")).sortWithinPartitions(F.desc("doc_id"))
    backwards.write.parquet(f"{tmp_path}/other")
    stored = llm.read.parquet(f"{tmp_path}/other")
    found = P.encode(llm, stored, str(tmp_path))
    assert {r.doc_id: r.place for r in found.collect()} == {k: 199 - k for k in range(200)}
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    some = P.encode(llm, stored.where("doc_id % 3 = 0"), str(tmp_path)).collect()
    assert sorted(r.place for r in some) == list(range(67))
