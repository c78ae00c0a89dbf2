"""Learned operators: held-out accuracy, defined results, pieces against brute force."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest

from visitlens.llm import langid, quality, toxicity, urls
from visitlens.llm import queries as Q
from visitlens.llm.tables import ship_code
from visitlens.llm.words import NOT_LETTER, slices

SF = "/root/testdata/sf0.01"
ODD = {1: None, 2: "", 3: " 12 !? ", 4: "Ünïcode " * 5000, 5: "plain words here", 6: "日本 \x00"}


def area(y, p):
    rank = np.argsort(np.argsort(p, kind="stable")) + 1
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 4 == 2


def texts(values, gap=None):
    import pyarrow as pa

    return next(iter(slices(pa.array(values, pa.string()), **({} if gap is None else {"gap": gap}))))[2]


def test_language_of_held_out_documents(spark):
    out = Q.op5_language_id(spark, SF).toPandas()
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    both = truth.merge(out, on="doc_id")
    assert len(both) == len(truth)
    assert (both.held_out == both.doc_id.map(held)).all()
    right = both[both.held_out].lang == both[both.held_out].lang_pred
    assert right.mean() > 0.97
    assert both.score.between(0, 1).all()


def test_language_ngrams_do_not_cross_texts():
    one = [langid.ngrams(texts([t])) for t in ("abc d", "É!x")]
    both = langid.ngrams(texts(["abc d", "É!x"]))
    for k, part in enumerate(one):
        here = both[0] == k
        assert (both[1][here] == part[1]).all() and (both[2][here] == part[2]).all()
    assert langid.ngrams(texts(["", "12", "é"]))[3].tolist() == [False, False, True]


def test_language_unusual_rows(spark, documents):
    rng = random.Random(0)
    train = {100 + i: " ".join(rng.choice(["alpha", "beta", "gamma"] if i % 2 else ["uno", "dos", "tres"]) for _ in range(9)) for i in range(60)}
    lang = {d: ("aa" if d % 2 else "bb") for d in train} | {d: None for d in ODD}
    docs = documents(train | ODD, lang=lang, order=[*train.items(), *ODD.items(), (5, ODD[5]), (None, "uno")])
    model = langid.fit_language_model(docs)
    assert model.languages == ["aa", "bb"] or model.languages == ["aa", "bb", "en"]
    rows = langid.predict_languages(docs, model).collect()
    assert len(rows) == len(train) + len(ODD) + 2
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        if r.doc_id in train:
            assert r.lang_pred == lang[r.doc_id]
        assert r.held_out == held(r.doc_id)
    empty = docs.limit(0)
    nothing = langid.fit_language_model(empty)
    assert langid.predict_languages(empty, nothing).collect() == []
    assert {r.lang_pred for r in langid.predict_languages(docs, nothing).collect()} == {"und"}
    assert langid.keep_identified(docs, model, 0.0).columns == docs.columns


def test_temperature_follows_the_odds():
    rng = np.random.default_rng(0)
    logits = np.stack([np.zeros(20_000), rng.normal(0, 2, 20_000)], 1)
    labels = (rng.random(20_000) < 1 / (1 + np.exp(-logits[:, 1] / 3))).astype(int)
    assert langid.fit_temperature(logits, labels) == pytest.approx(3, rel=0.15)


def test_machine_equals_the_pairwise_sum():
    rng = np.random.default_rng(0)
    size = quality.WORDS + quality.STATISTICS
    model = quality.FactorisationMachine(0.3, rng.normal(size=size), rng.normal(size=(size, 3)))
    doc, column, value = quality.vectors(texts(["a b a c", "", "zz\nzz"], NOT_LETTER), np.array([7.0, np.nan, 2.0]))
    got = model.logits(doc, column, value, 3)
    for d in range(3):
        at, x = column[doc == d], value[doc == d]
        want = 0.3 + model.linear[at] @ x
        want += sum(model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j] for i, j in combinations(range(len(at)), 2))
        assert got[d] == pytest.approx(want)


@pytest.mark.parametrize("query,label,least", [("op7_quality_classifier", "quality", 0.93), ("op8_toxicity", "toxic", 0.6)])
def test_classifiers_on_held_out_documents(spark, query, label, least):
    out = Q.QUERIES[query](spark, SF).toPandas()
    both = spark.read.parquet(f"{SF}/labels.parquet").toPandas().merge(out, on="doc_id")
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    part = both[both.held_out]
    assert area(part[label].to_numpy(), part.score.to_numpy()) > least
    limit = {"quality": 0.7, "toxic": 0.3}[label]
    assert ((out.score >= limit).astype(int) == out.predicted).all() and out.score.between(0, 1).all()


def test_bags_learn_one_bad_sentence(spark, documents):
    rng = random.Random(4)
    bodies, marks = {}, {}
    for d in range(700):
        sentences = [" ".join(f"word{rng.randrange(60)}" for _ in range(6)).replace("word", "wo" + "abc"[d % 3]) for _ in range(rng.randint(1, 30))]
        marks[d] = int(rng.random() < 0.3)
        if marks[d]:
            sentences[rng.randrange(len(sentences))] += " vile" + rng.choice(["ly", "ness", "st"])
        bodies[d] = ". ".join(sentences) + "."
    docs = documents(bodies | {1000: None, 1001: "", 1002: "...!"})
    labels = spark.createDataFrame([(d, y, y) for d, y in marks.items()] + [(3, 0, 1 - marks[3]), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).collect()}
    test = [d for d in bodies if held(d)]
    assert np.mean([out[d].predicted == marks[d] for d in test]) > 0.97
    found = [out[d].worst_text for d in test if marks[d] and out[d].predicted]
    assert np.mean(["vile" in t for t in found]) > 0.97
    assert out[1000].n_sentences == 0 and out[1000].worst_sentence is None and out[1002].n_sentences == 0
    # noisy-or over sentences, by hand
    bags = toxicity.BagModel(np.empty(0, np.uint64), np.empty(0), -1.0, 0.25)
    p = 1 / (1 + np.exp(1.0))
    assert bags.score(texts(["a. b! c", ""], NOT_LETTER))[0] == pytest.approx([1 - 0.75 * (1 - p) ** 3, 0.25])


def test_scores_of_unusual_rows(spark, documents):
    docs = documents(ODD, order=[*ODD.items(), (5, ODD[5]), (None, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for fit, score in ((quality.fit_quality, quality.score_quality), (toxicity.fit_toxicity, toxicity.score_toxicity)):
        model = fit(docs, none)
        rows = score(docs, model).collect()
        assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 5}) == 1
        assert score(docs.limit(0), model).collect() == []


def parse(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    stop = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path[:stop]


def test_url_rules_equal_brute_force(spark):
    ship_code(spark)
    given = ["https://a.com/x", "http://EXAMPLE.com/en/1?q#f", "http://m.example.com/en/", "https://www.example.com/en/2", "x://net/es/"]
    given += ["http://a.net/fr/?x", "http://a.net/de/", "http://notcom/", "http://com", "http://com/", "ftp://é.com?x=http://b.net/es/"]
    given += [None, "", "nourl", "http://", "://", "http://a.b://c.com/x", "http://a.com/\nx#y", "http://wwwwexample.com/en/", "HTTP://A.NET/ES/"]
    given += ["http://h.net/fr/" + "9" * 20_000]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(given)] + [(None, given[0], "")], "page_id long, url string, verdict string")
    rows = urls.filter_urls(df).collect()
    assert len(rows) == len(given) + 1
    for r in rows:
        host, path = parse(given[r.page_id or 0])
        fits = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path) == (host, path)
        assert r.rule == (max(fits)[1] if fits else None)
        assert r.verdict == max(fits)[2] if fits else r.verdict in ("allow", "block")
    assert urls.filter_urls(df.limit(0)).collect() == []


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5))
    y = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = urls.fit_trees(x[:3000], y[:3000])
    assert ((model.logits(x[3000:]) > 0) == (y[3000:] > 0)).mean() > 0.95
    assert urls.fit_trees(x, np.ones(len(x))).logits(x[:2]).min() > 0
    assert urls.fit_trees(np.empty((0, 5)), np.empty(0)).logits(x[:2]).tolist() == [0, 0]


def test_whole_pages_table(spark):
    out = Q.op9_url_filters(spark, SF).toPandas()
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").toPandas().merge(out, on="page_id")
    assert len(pages) == len(out) == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert all((r.host, r.path) == parse(r.url) for r in pages.itertuples())
