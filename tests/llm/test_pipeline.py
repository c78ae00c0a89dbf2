"""The pipeline's stages against the operators' brute-force versions."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as C
from visitlens.llm import components as components_module
from visitlens.llm import minhash, oracle, queries
from visitlens.llm.components import components
from visitlens.llm.tables import ship_code

from . import brute


def test_stages_on_a_small_corpus(spark, documents, corpus, tmp_path):
    docs = documents(corpus, source={d: f"s{d % 3}" for d in corpus})
    d = dict(C.STAGES)

    near = d["minhash_near_dedup"](spark, docs, "")
    want = {k for k, v in brute.near_documents(corpus).items() if v[2]}
    rows = near.collect()
    assert near.columns == docs.columns
    assert sorted(r.doc_id for r in rows) == sorted(want)

    cut = d["substring_dedup"](spark, docs, "")
    lost = brute.cut_passages(corpus)
    assert cut.columns == docs.columns
    got = {r.doc_id: r for r in cut.collect()}
    assert set(got) == {k for k, (n, gone, _) in lost.items() if gone < n or not gone}
    for k, r in got.items():
        assert len(brute.words(r.text)) == lost[k][0] - lost[k][1]
        if not lost[k][1]:
            assert r.text == corpus[k]
        else:
            assert r.n_chars == len(r.text)

    mixed = d["mix_sources"](spark, docs, "").collect()
    size = {k: len(brute.words(t)) for k, t in corpus.items()}
    per = {}
    for k in corpus:
        per[f"s{k % 3}"] = per.get(f"s{k % 3}", 0) + size[k]
    target = brute.targets(per)
    for s in per:
        assert abs(sum(size[r.doc_id] for r in mixed if r.source == s) - target[s]) <= 0.02 * target[s] + 10


def test_stages_on_unusual_rows(spark, documents):
    order = [(1, "uno dos tres"), (1, "uno dos tres"), (2, None), (None, "uno dos"), (None, "uno dos"), (3, ""), (4, "uno dos cuatro " * 4000)]
    docs = documents({}, order=order, lang={1: "es", 4: "es"}, source={1: None})
    empty = docs.limit(0)
    for name, stage in C.STAGES:
        out = stage(spark, docs, "").collect()
        if name == "language_id":
            assert {r.doc_id for r in out} == {1, None, 4}
        if name == "minhash_near_dedup":
            assert sorted(str(r.doc_id) for r in out) == ["1", "4", "None", "None"]
        assert stage(spark, empty, "").collect() == []
        docs = docs if name == C.STAGES[-1][0] else spark.createDataFrame(out, docs.schema)


def test_stages_with_columns_of_any_name(spark, documents, corpus):
    extra = ["__text", "__left", "__copies", "__copy", "kept_text", "left_words", "Copies", "copy", "row", "least", "size", "component"]
    docs = documents(corpus, source={d: f"s{d % 3}" for d in corpus})
    for i, name in enumerate(extra):
        docs = docs.withColumn(name, F.lit(i))
    docs = docs.cache()
    names = docs.columns
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == names, name
        assert all(r[extra[0]] == 0 and r["copy"] == 7 for r in out.collect())
    assert C.STAGES[-1][1](spark, docs, "").count() == len(corpus)
    docs.unpersist()


def test_language_stage_rejects_junk_even_with_one_language(spark, documents):
    rng = random.Random(1)
    prose = {i: " ".join(rng.choice(["the", "water", "runs", "under", "this", "old", "bridge"]) for _ in range(60)) for i in range(200)}
    junk = {1000: "xqzj vkwq zzxq jjkq " * 20, 1001: "".join(rng.choice("qxzjkvw") for _ in range(300)), 1002: "Съешь же ещё этих мягких булок " * 5}
    docs = documents(prose | junk, lang={d: None for d in junk})
    kept = {r.doc_id for r in C.language_id(spark, docs, "").collect()}
    assert kept == set(prose)


def test_components(spark):
    ship_code(spark)
    links = [(1, 2), (2, 3), (9, 3), (5, 5), (7, 8), (8, 7), (20, 19), (19, 18), (18, 17), (17, 16), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 7: 7, 8: 7, **{k: 16 for k in range(16, 21)}}
    assert components(df.limit(0)).collect() == []


def _counted(monkeypatch, module):
    names, write = [], module.written
    monkeypatch.setattr(module, "written", lambda df, what: names.append(what) or write(df, what))
    return names


def test_components_of_random_graphs_without_a_round_too_many(spark, monkeypatch):
    ship_code(spark)
    rng = random.Random(3)
    written = _counted(monkeypatch, components_module)
    for n, m in ((40, 15), (40, 30), (60, 90)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(200 + i, 201 + i) for i in range(20)]
        label = {x: x for pair in links for x in pair if pair[0] != pair[1]}
        for _ in label:
            for a, b in links:
                if a != b:
                    label[a] = label[b] = min(label[a], label[b])
        got = components(spark.createDataFrame(links, "a long, b long")).collect()
        assert {r.node: r.component for r in got} == label and len(got) == len(label)
    written.clear()
    stars = [(i, i % 3) for i in range(3, 30)]
    assert {r.node: r.component for r in components(spark.createDataFrame(stars, "a long, b long")).collect()} == {i: i % 3 for i in range(30)}
    assert written == ["edges"]


def test_near_duplicates_writes_nothing_after_an_empty_intermediate(spark, documents, monkeypatch):
    ship_code(spark)
    written = _counted(monkeypatch, minhash)
    prose = {i: " ".join(f"w{i}x{k}" for k in range(80)) for i in range(20)}
    near = {100 + i: f"{prose[i]} end" for i in range(5)}
    kept = C.minhash_near_dedup(spark, documents(prose | near), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(prose)
    assert written.count("minhash-survivors") == written.count("minhash-sets") == written.count("minhash-links") == 1
    assert "minhash-open" not in written and "minhash-linkable-ids" not in written


def test_registration():
    import __spark_entry__ as E

    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(oracle.SQL) <= set(queries.QUERIES) and "pipeline" in E.queries()
    assert [n for n, _ in C.STAGES] == ["language_id", "minhash_near_dedup", "substring_dedup", "mix_sources", "sentencepiece"]


def test_merged_random_graphs(spark):
    ship_code(spark)
    for seed in (3, 4):
        draw = random.Random(seed)
        first, more = ([(draw.randrange(300), draw.randrange(300)) for _ in range(n)] for n in (120, 100))
        low = {i: i for i in range(300)}
        for _ in range(300):
            for x, y in first + more:
                low[x] = low[y] = min(low[x], low[y])
        frames = [spark.createDataFrame(links, "a long, b long") for links in (first, [*more, *more, (7, None), (None, None)])]
        got = components_module.merged(components_module.star_edges(frames[0]), frames[1]).collect()
        assert sorted((r.node, r.component) for r in got) == [(i, c) for i, c in low.items() if i != c]


def test_copies_of_near_copies_need_no_round_of_stars(spark, documents, monkeypatch):
    words = [f"w{i}" for i in range(200)]
    near = " ".join(["other", *words[1:]])
    written = _counted(monkeypatch, components_module)
    got = minhash.near_duplicates(documents({1: " ".join(words), 2: near, 3: near, 4: near, 5: "alone"}))
    assert {r.doc_id: r.component_id for r in got.collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5}
    assert written.count("edges") == 2  # the links, then the copies joined to their components
