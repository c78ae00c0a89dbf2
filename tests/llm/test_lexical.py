"""Length-stratified search against brute force."""

import math
import random
import re
from collections import Counter

import pytest

from visitlens.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, top=10):
    """(item, rank) -> (doc_id, score); docs and items are (id, text) rows."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    holders = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = {}
    for item, words in asked.items():
        scored = []
        for d, bag in bags:
            m = 100 - 90 + 90 * sum(bag.values()) * n_docs // n_terms
            score = 0
            for w in words & bag.keys():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[w] + 1)))
                score += weight * (1000000000 * bag[w] // (1000 * bag[w] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        for rank, (score, _, _, d) in enumerate(sorted(scored, key=lambda s: s[:3])[:top], 1):
            out[item, rank] = d, -score
    return out


@pytest.fixture
def tables(spark):
    rng = random.Random(21)
    vocabulary = [f"t{i}" for i in range(80)] + ["É", "日本"]
    weights = [1 / (1 + i) for i in range(len(vocabulary))]
    prose = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    docs = [(d, prose(rng.choice([3, 8, 8, 8, 30, 90]))) for d in range(400)]
    docs += [(500, None), (501, ""), (502, " .;"), (503, "T1, t1! É"), (None, docs[5][1]), (7, docs[7][1]), (7, docs[8][1])]
    docs += [(600 + i, docs[3][1].upper()) for i in range(25)] + [(700, "t40 " * 20000)]
    items = [(i, prose(rng.randint(1, 12))) for i in range(25)]
    items += [(30, None), (31, "..."), (32, "unknown"), (33, "t1 unknown T1"), (None, "t2 t3"), (1, "t70 t71"), (34, "t40")]
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, rank int, item_id string")
    asked = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, score int")
    return docs, items, frame, asked


def _found(df):
    rows = df.collect()
    assert len({(r.item_id, r["rank"]) for r in rows}) == len(rows)
    return {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in rows}


def test_equals_brute_force(tables):
    docs, items, frame, asked = tables
    assert _found(L.lexical_search(frame, asked)) == brute(docs, items)


def test_many_small_blocks_of_postings_and_items(monkeypatch, tables):
    docs, items, frame, asked = tables
    monkeypatch.setattr(L, "BLOCK_POSTINGS", 50)
    assert _found(L.lexical_search(frame.repartition(5), asked, top=3, query_terms=60)) == brute(docs, items, 3)


def test_reruns_and_other_partitions_agree(tables):
    _, _, frame, asked = tables
    assert _found(L.lexical_search(frame.repartition(3), asked)) == _found(L.lexical_search(frame.repartition(11), asked))


def test_empty_tables(tables):
    _, _, frame, asked = tables
    assert L.lexical_search(frame.limit(0), asked).count() == 0
    assert L.lexical_search(frame, asked.limit(0)).count() == 0
    assert L.lexical_search(frame.filter("doc_id IN (500, 501, 502)"), asked).count() == 0


def test_bounds_hold_for_every_document():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(4)
    rows = []
    for _ in range(60):
        term = np.flatnonzero(rng.random(20) < 0.3).astype(np.int32)
        rows.append(term.tobytes() + rng.integers(1, 6, len(term)).astype(np.int32).tobytes())
    group = pa.table({"m": [40] * 60, "block": pa.array([0] * 60, pa.int32()), "doc_id": list(range(60)), "entries": pa.array(rows, pa.binary())})
    made = L._block(group).to_pylist()[0]
    weights = rng.integers(1, 9000, 20)
    runs = L._Runs(40, made["run_term"], made["run_tf"], weights)
    items = L.Items([0, 1], np.array([0, 4, 9]), rng.permutation(20)[:9])
    postings = L._Postings(runs, made["run_end"], made["documents"], 60, 20)
    for i, bound in enumerate(runs.bounds(items, 20).tolist()):
        terms_of = items.terms[items.first[i] : items.first[i + 1]]
        scores = postings.scores(terms_of, bound)
        assert scores.max() <= bound
        assert (scores == postings.scores(terms_of, 1 << 60)).all()


def test_a_task_holds_few_blocks_unpacked(monkeypatch):
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    term = np.array([0], np.int32).tobytes()
    tf, end = (np.array([1], np.int32).tobytes() for _ in range(2))
    held, most = [], [0]

    class Counted(L._Runs):
        def __init__(self, *args):
            super().__init__(*args)
            held.append(1)
            most[0] = max(most[0], len(held))

        def __del__(self):
            held.pop()

    monkeypatch.setattr(L, "_Runs", Counted)
    rows = [(10 + b, term, tf, end, np.array([0], np.int32).tobytes(), [b]) for b in range(500)]
    names = ["m", "run_term", "run_tf", "run_end", "documents", "ids"]
    types = [pa.int64(), *[pa.binary()] * 4, pa.list_(pa.int64())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    items = L.Items([0], np.array([0, 1]), np.array([0]))
    shared = SimpleNamespace(value=(items, np.array([1000]), np.zeros(1, np.int64)))
    found = next(L._search(shared, 1, 3)(iter([batch]))).to_pydict()
    assert found["doc_id"] == [0, 1, 2]
    assert most[0] < 100
