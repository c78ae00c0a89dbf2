"""Texts built to collide, reruns over other partitions, many sources, repeated ids."""

import random

import numpy as np
import pytest

from visitlens.llm import minhash, mixing, repetition, substring, words
from visitlens.llm.tables import ship_code

from . import brute


def thue_morse(n, a, b):
    return [b if bin(i).count("1") % 2 else a for i in range(n)]


def texts(*values):
    import pyarrow as pa

    return next(iter(words.slices(pa.array(values, pa.string()))))[2]


def test_regular_words_and_sequences_do_not_collide():
    a, b = "".join(thue_morse(1024, "a", "b")), "".join(thue_morse(1024, "b", "a"))
    h = texts(a, b).word_hashes()
    assert h[0] != h[1]
    for n in (64, 512, 4096):
        t = texts(" ".join(thue_morse(n, "x", "y")), " ".join(thue_morse(n, "y", "x")))
        for seed in (0, 1):
            one, two = words.Rolling(t.word_hashes(), seed).spans(t.first[:-1], t.first[1:])
            assert one != two


def test_word_hashes_tell_words_apart_and_know_equal_ones():
    rng = random.Random(0)
    some = ["".join(rng.choice("ab") for _ in range(n)) for n in list(range(1, 40)) * 30 + [511, 512, 513, 600, 5000]]
    some += ["a" * n for n in range(1, 700)]
    h = texts(" ".join(some)).word_hashes()
    seen = {}
    for w, x in zip(some, h.tolist(), strict=True):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
    again = texts(" \t".join(w.upper() for w in some)).word_hashes(lower=True)
    assert (again == h).all()


def test_rolling_spans_depend_on_content_only():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    h[200:250] = h[20:70]
    for seed in (0, 1):
        r = words.Rolling(h, seed)
        assert r.spans(np.array([20]), np.array([70])) == r.spans(np.array([200]), np.array([250]))
        starts = np.arange(250)
        spans = r.spans(starts, starts + 50)
        assert len(set(spans.tolist())) == 249


def test_substrings_of_regular_texts_stay(documents):
    docs = {1: " ".join(thue_morse(4096, "x", "y")), 2: " ".join(thue_morse(4096, "p", "q")), 3: " ".join(thue_morse(700, "y", "x"))}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup_substrings(documents(docs)).collect()}
    assert got == brute.cut_passages(docs)
    assert got[2][1] == 0


def test_lines_and_words_of_a_kilobyte(documents):
    a, b = "".join(thue_morse(1024, "a", "b")), "".join(thue_morse(1024, "b", "a"))
    docs = {1: f"{a}\n{b}\n{a}", 2: a, 3: b}
    got = {r.doc_id: r for r in repetition.repetition_coverage(documents(docs)).collect()}
    assert got[1].n_dup_lines == brute.repetition_base(docs[1])[3] == 1
    near = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(documents(docs)).collect()}
    assert near == brute.near_documents(docs)


def _taken(df):
    return sorted((str(r.doc_id), r.size, str(r.source), r.taken, round(r.target, 6)) for r in df.collect())


def test_mixing_reruns_agree_with_null_and_repeated_ids(spark):
    ship_code(spark)
    rng = random.Random(3)
    rows = [(None if i % 3 else 7, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice([5, 5, 5, 9]))), rng.choice(["a", "b", None])) for i in range(400)]
    rows += [(None, "one and the same text", "a")] * 150 + [(8, "long " * 9000, "b")]
    runs = []
    for parts in (1, 3, 7):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        runs.append(_taken(mixing.mix_sources(df)))
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    for s, target in brute.targets(sizes).items():
        taken = sum(t for _, _, source, t, _ in runs[0] if source == str(s))
        assert abs(taken - target) <= 0.01 * target + 9000 * (s == "b") + 10
    assert all(t <= 2 * size for _, size, _, t, _ in runs[0])


def test_rates_equal_a_bisection_over_documents(spark):
    """The tilt of every source, solved document by document."""
    ship_code(spark)
    rng = random.Random(5)
    rows = [(i, "w " * rng.choice([1, 4, 30, 200, 900]), f"s{i % 4}") for i in range(600)]
    out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    for source, part in out.groupby("source"):
        size, target = part["size"].to_numpy(float), part["target"].iloc[0]
        if target >= 2 * size.sum():
            assert (part["rate"] == 2).all()
            continue
        low, high = -1e3, 1e3
        for _ in range(200):
            lam = (low + high) / 2
            rate = 2 / (1 + np.exp(-np.clip(lam * size / size.mean(), -700, 700)))
            low, high = (lam, high) if (rate * size).sum() < target else (low, lam)
        assert np.allclose(part["rate"], rate, rtol=1e-4, atol=1e-6)


def test_a_dual_that_does_not_converge_is_an_error(spark, monkeypatch):
    ship_code(spark)
    monkeypatch.setattr(mixing, "ROUNDS", 1)
    df = spark.createDataFrame([(i, "w " * (1 + i % 90), f"s{i % 4}") for i in range(300)], "doc_id long, text string, source string")
    with pytest.raises(RuntimeError, match="converge"):
        mixing.mix_sources(df)


def test_many_sources_are_ranked_by_code_point(spark, monkeypatch):
    from visitlens.operators import ranking

    ship_code(spark)
    names = [f"host{i}.com" for i in range(900)] + ["Z", "é", "日本", "", None]
    df = spark.createDataFrame([(n, 10) for n in names], "source string, source_size long")
    monkeypatch.setattr(mixing, "split_large_groups", lambda d, g, k: ranking.split_large_groups(d, g, k, rows=50))
    got = {r.source: (r.sid, r.target) for r in mixing.source_targets(df, (5.0, 2.0, 1.0), 1.5, 2.0).collect()}
    order = sorted([n for n in names if n is not None], key=lambda n: n.encode()) + [None]
    assert [got[n][0] for n in order] == list(range(1, len(order) + 1))
    want = brute.targets({n: 10 for n in names})
    assert all(got[n][1] == pytest.approx(want[n]) for n in names)


def test_one_text_of_a_repeated_id_is_compared(spark, documents):
    base = " ".join(f"w{i}" for i in range(60))
    order = [(1, base), (2, base + " x"), (2, "other words " * 20), (3, base + " y"), (3, base + " z"), (None, base)]
    runs = set()
    for parts in (1, 4, 6):
        docs = documents({}, order=order).repartition(parts)
        runs.add(str(sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect())))
    assert len(runs) == 1
