"""Suffix-automaton decontamination against brute force."""

import random
import re

import pytest

from visitlens.llm import decontamination as D

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(text, items, window=10):
    """n_words, hit places and items of one text; ``items`` are (id, text) rows."""
    words, hit, found = terms(text), set(), set()
    for item, item_text in items:
        own = terms(item_text)
        k = min(window, len(own))
        windows = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
        for i in range(len(words) - k + 1):
            if own and tuple(words[i : i + k]) in windows:
                hit.update(range(i, i + k))
                if item is not None:
                    found.add(str(item))
    return len(words), hit, sorted(found)


@pytest.fixture
def tables(spark, documents):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "日本", "z9"]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(prose(rng.choice([12, 15, 25, 40])))) for i in range(30)]
    items += [(40, "one two three"), (41, "two three"), (42, "lonely"), (43, None), (44, " .,; "), (None, "no id at all here")]
    items += [(1, items[5][1]), (50, items[6][1]), (51, "a b " * 60), (52, " ".join(prose(300)))]
    texts = {}
    for d in range(60):
        parts = prose(rng.randint(0, 30))
        for _ in range(rng.randint(0, 3)):
            own = terms(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(own) - 5))
            parts += own[a : a + rng.randint(1, 30)] + prose(rng.randint(0, 9))
        sep = rng.choice([" ", ", ", "\n", "--"])
        texts[d] = sep.join(w.upper() if rng.random() < 0.3 and w.isascii() else w for w in parts)
    texts |= {60: None, 61: "", 62: " ... ", 63: "One. TWO, three!", 64: "lonely", 65: "a b " * 5000, 66: "no id at all here"}
    bench = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id int, n_words int")
    return items, texts, bench


@pytest.mark.parametrize("shard_words", [1 << 17, 150])
def test_equals_brute_force(documents, tables, shard_words):
    items, texts, bench = tables
    found = {r.doc_id: r for r in D.find_contamination(documents(texts), bench, shard_words=shard_words).collect()}
    assert set(found) == set(texts)
    for d, text in texts.items():
        n, hit, listed = brute(text, items)
        r = found[d]
        assert r.n_words == n and r["items"] == listed
        assert [p for s in r.spans for p in range(s.start, s.end)] == sorted(hit)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_long_items_are_cut_with_overlap(monkeypatch, documents, tables, spark):
    items, texts, bench = tables
    monkeypatch.setattr(D, "PIECE_WORDS", 20)
    found = D.find_contamination(documents(texts), bench).collect()
    for r in found:
        assert sum(s.end - s.start for s in r.spans) == len(brute(texts[r.doc_id], items)[1])


def test_ids_and_rows(spark, tables):
    _, _, bench = tables
    rows = [(None, "one two three"), (7, "one two three"), (7, "clean"), (7, "clean")]
    found = D.find_contamination(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    got = sorted((str(r.doc_id), r.n_words, len(r.spans), tuple(r["items"])) for r in found)
    assert got == [("7", 1, 0, ()), ("7", 1, 0, ()), ("7", 3, 1, ("40", "41")), ("None", 3, 1, ("40", "41"))]


def test_empty_tables(spark, documents, tables):
    _, texts, bench = tables
    assert D.find_contamination(documents({1: "x"}).limit(0), bench).count() == 0
    clean = D.find_contamination(documents(texts), bench.limit(0)).collect()
    assert len(clean) == len(texts) and not any(r.spans or r["items"] for r in clean)


def test_removal(spark, documents):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    texts = {1: "Keep, this! A b c d e-f g h i, J and this: too", 2: "a b c d e f g h i j k", 3: None, 4: "fine", 5: "a b c d e f g h i"}
    got = {r.doc_id: r.text for r in D.remove_contamination(documents(texts), bench, max_coverage=0.7).collect()}
    assert got == {1: "Keep, this!  and this: too", 2: "", 3: None, 4: "fine", 5: "a b c d e f g h i"}


def test_automaton_knows_all_substrings():
    rng = random.Random(2)
    pieces = [("x", False, [rng.choice([b"a", b"b", b"c"]) for _ in range(n)]) for n in (30, 25, 40)]
    automaton = D.build_automaton(pieces, 4)
    moves, n = dict(zip(automaton.keys.tolist(), automaton.targets.tolist())), len(automaton.words)
    inside = {tuple(w[i:j]) for _, _, w in pieces for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
    for length in range(1, 7):
        for code in range(3**length):
            word = tuple([b"a", b"b", b"c"][code // 3**k % 3] for k in range(length))
            state = 0
            for w in word:
                state = moves.get(state * n + automaton.words.index(w)) if state is not None else None
            assert (state is not None) == (word in inside)
    assert len(automaton.link) <= 2 * sum(len(w) for _, _, w in pieces)
