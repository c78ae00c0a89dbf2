"""Document operators against brute force, and their results on unusual rows."""

import numpy as np
import pytest

from visitlens.llm import minhash, repetition, substring
from visitlens.llm.mixing import mix_sources
from visitlens.llm.substring import COVERS, cover_for, is_cover

from . import brute


def rows(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_covers_are_covers():
    assert all(is_cover(v, members) for v, members in COVERS.items())
    assert cover_for(50)[0] == 31
    with pytest.raises(ValueError):
        cover_for(1)


def test_substrings_equal_brute_force(documents, corpus):
    got = rows(substring.dedup_substrings(documents(corpus)), "n_words", "n_removed", "kept_sha256")
    want = brute.cut_passages(corpus)
    assert got == want
    assert sum(w[1] > 0 for w in want.values()) > 30


def test_substrings_of_another_window(documents):
    base = [f"k{i}" for i in range(40)]
    texts = {i: " ".join(base[i : i + 20] + [f"z{i}"] + base[: 2 * i]) for i in range(8)}
    got = rows(substring.dedup_substrings(documents(texts), window=9), "n_words", "n_removed", "kept_sha256")
    assert got == brute.cut_passages(texts, 9)


def test_substrings_text_and_repeated_ids(spark, documents):
    long = " ".join(f"v{i}" for i in range(60))
    df = documents({}, order=[(1, long), (1, long), (2, "a " + long), (None, long), (3, long)])
    got = sorted(((r.doc_id, r.n_removed, r.kept_text) for r in substring.dedup_substrings(df, with_text=True).collect()), key=str)
    # rows of one id do not cut each other; a null id neither cuts nor is cut
    assert got == sorted([(1, 0, None), (1, 0, None), (2, 60, "a"), (None, 0, None), (3, 60, "")], key=str)


def test_substrings_of_different_texts_with_one_id(spark, documents):
    long = " ".join(f"v{i}" for i in range(60))
    df = documents({}, order=[(1, long), (2, "a " + long), (2, None), (2, "a b c d e")]).coalesce(1)
    got = sorted(((r.doc_id, r.n_removed, r.kept_text) for r in substring.dedup_substrings(df, with_text=True).collect()), key=str)
    assert got == sorted([(1, 0, None), (2, 60, "a"), (2, 0, None), (2, 0, None)], key=str)


@pytest.mark.parametrize("block", [512, 16])
def test_near_documents_equal_brute_force(documents, corpus, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    got = rows(minhash.near_duplicates(documents(corpus)), "n_shingles", "component_id", "kept")
    assert got == brute.near_documents(corpus)


def test_texts_too_different_to_link_meet_in_no_block(documents, monkeypatch):
    made, blocks = [], minhash._blocks

    def counted(*args):
        grouped = blocks(*args)
        made.append(grouped._df.count())
        return grouped

    monkeypatch.setattr(minhash, "_blocks", counted)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    texts = {}
    for d in range(40):  # three words apart from a common text each, in buckets with each other
        words = [f"w{i}" for i in range(100)]
        for e in range(3):
            words[10 + 30 * e + d % 7] = f"d{d}e{e}"
        texts[d] = " ".join(words)
    got = rows(minhash.near_duplicates(documents(texts)), "n_shingles", "component_id", "kept")
    assert got == brute.near_documents(texts)
    assert made == [0, 0]


def test_blocks_grow_with_the_bucket_not_its_square(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    component = {d: 0 if d < 400 else d for d in range(414)}
    members = spark.createDataFrame([(7, d, 9) for d in component], "bucket long, doc_id long, n long")
    groups = spark.createDataFrame(list(component.items()), "node long, component long")
    sigs = spark.createDataFrame([(d, b"") for d in component], "doc_id long, sig binary")
    found = minhash._blocks(minhash._apart(members, groups), sigs)._df.collect()
    assert len(found) < 2 * len(component)
    met, at = {}, {}
    for r in found:
        at.setdefault((r.low_chunk, r.high_chunk), []).append((r.doc_id, r.chunk))
    for (low, high), there in at.items():
        for a in (d for d, c in there if c == low):
            for b in (d for d, c in there if c == high and (low != high or d > a)):
                met[min(a, b), max(a, b)] = met.get((min(a, b), max(a, b)), 0) + 1
    assert met == {(a, b): 1 for b in component for a in range(b) if component[a] != component[b]}


def test_near_documents_repeated_and_null_ids(documents):
    df = documents({}, order=[(4, "a b c d e f"), (4, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (9, None)])
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(4, 2, False), (4, 2, False), (2, 2, True), (None, None, True), (9, 9, True)], key=str)


def test_pruning_bounds():
    # P(Binomial(n + 1, t) <= m) by simulation
    draws = np.random.default_rng(0).binomial(33, 0.75, 400_000)
    m = minhash.least_matches(32, 0.75, 0.01)
    assert (draws <= m).mean() >= 0.009 and (draws <= m - 1).mean() <= 0.011
    assert minhash.least_matches(32, 0.75, 0.0) == 0


def test_repetition_equals_brute_force(documents, corpus):
    texts = corpus | {2000: "same line here\n" * 30 + "another one", 2001: "|" * 9 + " # $ " + "w " * 70, 2002: "a\n\n \nb\r\na\nb\r"}
    limits = repetition.RepetitionLimits()
    for r in repetition.repetition_coverage(documents(texts)).collect():
        text = texts[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.repetition_base(text)
        want = brute.repetition_shares(text, limits.top_ngram, limits.dup_ngram)
        assert all(abs(r[k] - v) < 1e-9 for k, v in want.items())
        good = all(want[f"top_{n}gram_share"] <= x for n, x in limits.top_ngram.items())
        good &= all(want[f"dup_{n}gram_share"] <= x for n, x in limits.dup_ngram.items())
        good &= r.dup_line_char_share <= limits.dup_line_chars
        assert r.kept == (good and not r.base_failed)


def test_mixing_meets_its_targets(spark, documents):
    rng = np.random.default_rng(2)
    sizes = {"b": 300, "a": 200, "é": 150, None: 120, "Z": 250}
    texts, source = {}, {}
    for s, n in sizes.items():
        for size in rng.lognormal(4, 1, n).astype(int):
            texts[len(texts)], source[len(source)] = "w " * int(size), s
    texts[len(texts)], source[len(source)] = None, "a"
    texts[len(texts)], source[len(source)] = "g " * 30_000, "b"
    df = documents(texts, source=source)
    out = mix_sources(df).toPandas()
    assert len(out) == len(texts)
    assert dict(zip(out.doc_id, out["size"])) == {d: len(brute.words(t)) for d, t in texts.items()}
    assert (out.taken <= 2 * out["size"]).all() and (out.taken % out["size"].clip(lower=1) == 0).all()
    out["key"] = out.source.where(out.source.notna(), None).map(lambda s: s if isinstance(s, str) else None)
    per = {s: g for s, g in out.groupby(out.key.fillna("\0null"))}
    want = brute.targets({s: int(per[s or "\0null"]["size"].sum()) for s in sizes})
    for s in sizes:
        g = per[s or "\0null"]
        assert (g.source_size == g["size"].sum()).all()
        assert np.allclose(g.target, want[s])
        assert abs(g.taken.sum() - want[s]) <= 0.005 * want[s] + 2
    again = mix_sources(df.repartition(5)).toPandas()
    assert dict(zip(again.doc_id, again.taken)) == dict(zip(out.doc_id, out.taken))


def test_mixing_subcells_and_hot_sizes(spark, documents, monkeypatch):
    from visitlens.llm import mixing

    monkeypatch.setattr(mixing, "SUBCELL", 10)
    texts = {i: "same words here" for i in range(400)} | {400 + i: "w " * i for i in range(20)}
    out = mix_sources(documents(texts, source={i: "ab"[i % 2] for i in texts})).toPandas()
    for _, g in out.groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 3


def test_empty_tables(documents):
    empty = documents({0: "x"}).limit(0)
    assert substring.dedup_substrings(empty).collect() == []
    assert minhash.near_duplicates(empty).collect() == []
    assert repetition.repetition_coverage(empty).collect() == []
    assert mix_sources(empty).collect() == []
