"""Benchmark decontamination by a generalised suffix automaton of the test items.

A window is ``window`` consecutive words of a test item; an item with fewer words, but not
none, is one window.  A word of a document is hit if it lies in an occurrence of a window.

Method: the words of the test items become numbers, and one suffix automaton is built over
all items.  A document's words are streamed through it: the state after each word is the
longest suffix that occurs in some item, and its length says whether a window ends here.
Words that no item has reset the automaton, so only runs of known words that are long
enough for a window are streamed at all.  The suffix link of a state leads to the state of
its last ``window`` words, which lists the items that hold them; short items are found on the
path of links.  Words are compared as bytes, never by hash.

Scale: documents are read once, in one pass without a shuffle, as long as the items fit one
automaton.  An automaton holds about ``SHARD_WORDS`` words (a quarter of a million states and
more, some 60 MB in a Python worker); larger test sets are dealt to several automata, each
of which makes one pass that adds to what the passes before it found.  Very long items are
cut into pieces that overlap by ``window - 1`` words, so an automaton stays bounded whatever
an item's length, and equal pieces of one item are folded before they are dealt.  Work per
word does not depend on how often a passage occurs.

Defined results: a null text has no words; one row results per input row, whatever its id
(null and repeated ids too).  Items with a null text or without words have no windows.  An
item without an id marks words, but is not listed.  Rows that repeat an item id are one
item with the windows of all of them.  Other columns are ignored; empty documents give an
empty result, an empty test set leaves all documents clean.  A very long text takes memory
in proportion to itself in its own task only.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import ship_code, written
from .terms import TERM, raw_texts, term_list

WINDOW = 10
#: Words of one automaton, about; words of one piece of an item.
SHARD_WORDS, PIECE_WORDS = 1 << 17, 1 << 12


class Automaton(NamedTuple):
    """States are numbered from 0, the root; transitions are kept under state * words + word."""

    window: int
    words: list[bytes]
    keys: np.ndarray
    targets: np.ndarray
    link: np.ndarray
    length: np.ndarray
    #: state of the last ``window`` words of a state's longest string (0: it has fewer)
    tail: np.ndarray
    #: nearest state up the links that is a whole short item (0: none)
    above: np.ndarray
    #: per state, the items whose window (or whole short item) it stands for
    items: dict[int, list[str]]
    #: states that are whole short items
    whole: frozenset[int]
    #: words of the shortest window
    shortest: int


class _Builder:
    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A state of its own for the target's strings that are one word longer than ``state``'s."""
        part = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = part
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = part
            state = self.link[state]
        return part

    def _at(self, state: int, word: int) -> int:
        target = self.next[state][word]
        return target if self.length[target] == self.length[state] + 1 else self._split(state, word, target)

    def extend(self, last: int, word: int) -> int:
        """The state of ``last``'s longest string followed by ``word``."""
        if word in self.next[last]:
            return self._at(last, word)
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._at(state, word)
        return new


def build_automaton(pieces: list[tuple[str | None, bool, list[bytes]]], window: int = WINDOW) -> Automaton:
    """The automaton of ``(item, is a whole short item, words)``; an item's long pieces overlap."""
    number: dict[bytes, int] = {}
    coded = [[number.setdefault(w, len(number)) for w in words] for _, _, words in pieces]
    made = _Builder()
    for words in coded:
        last = 0
        for word in words:
            last = made.extend(last, word)
    link, length = np.array(made.link), np.array(made.length)
    tail = np.zeros(len(link), np.int64)
    for state in np.argsort(length, kind="stable")[1:]:
        if length[state] >= window:
            tail[state] = state if length[link[state]] < window else tail[link[state]]

    found: dict[int, set[str | None]] = {}
    whole: set[int] = set()
    for (item, is_short, _), words in zip(pieces, coded):
        state = 0
        for at, word in enumerate(words, 1):
            state = made.next[state][word]
            if not is_short and at >= window:
                found.setdefault(int(tail[state]), set()).add(item)
        if is_short and words:
            whole.add(state)
            found.setdefault(state, set()).add(item)
    above = np.zeros(len(link), np.int64)
    if whole:
        for state in np.argsort(length, kind="stable")[1:]:
            up = int(link[state])
            above[state] = up if up in whole else above[up]
    sizes = [len(m) for m in made.next]
    origin = np.repeat(np.arange(len(link)), sizes)
    moves = np.array([w for m in made.next for w in m], np.int64)
    targets = np.array([t for m in made.next for t in m.values()], np.int64)
    shortest = min([len(words) for words in coded if words], default=window)
    listed = {s: sorted(i for i in names if i is not None) for s, names in found.items()}
    return Automaton(window, list(number), origin * max(1, len(number)) + moves, targets, link, length, tail, above,
                     listed, frozenset(whole), min(window, shortest))


class Matcher:
    """Streams word numbers through an automaton; plain lists and dicts, made once per task."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.number = {w: i for i, w in enumerate(automaton.words)}
        self.moves = dict(zip(automaton.keys.tolist(), automaton.targets.tolist()))
        self.link, self.length = automaton.link.tolist(), automaton.length.tolist()
        self.tail, self.above = automaton.tail.tolist(), automaton.above.tolist()

    def _stream(self, words: list[int], first: int, starts: list[int], ends: list[int], states: set[int]) -> None:
        moves, link, length, n = self.moves, self.link, self.length, len(self.automaton.words)
        window, whole, state, matched = self.automaton.window, self.automaton.whole, 0, 0
        for at, word in enumerate(words, first + 1):
            to = moves.get(state * n + word)
            while to is None:  # every known word has a move from the root
                state = link[state]
                matched = length[state]
                to = moves.get(state * n + word)
            state, matched = to, matched + 1
            if matched >= window:
                starts.append(at - matched)
                ends.append(at)
                states.add(self.tail[state])
            if whole:
                up = state if state in whole and matched == length[state] else self.above[state]
                while up:
                    starts.append(at - length[up])
                    ends.append(at)
                    states.add(up)
                    up = self.above[up]

    def find(self, words: list[bytes], hit: np.ndarray) -> set[int]:
        """Mark the words of occurring windows in ``hit``; returns the states of the windows."""
        states: set[int] = set()
        if not self.number or len(words) < self.automaton.shortest:
            return states
        codes = np.fromiter((self.number.get(w, -1) for w in words), np.int64, len(words))
        known = np.zeros(len(words) + 2, np.int8)
        known[1:-1] = codes >= 0
        edges = np.diff(known)
        first, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        long = end - first >= self.automaton.shortest
        starts: list[int] = []
        ends: list[int] = []
        for lo, hi in zip(first[long].tolist(), end[long].tolist()):
            self._stream(codes[lo:hi].tolist(), lo, starts, ends, states)
        if starts:
            step = np.zeros(len(words) + 1, np.int64)
            np.add.at(step, starts, 1)
            np.add.at(step, ends, -1)
            hit |= np.cumsum(step[:-1]) > 0
        return states


def _pieces(window: int):
    step = PIECE_WORDS - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column(0).to_pylist()
            for item, raw in zip(items, raw_texts(batch.column(1))):
                words = term_list(raw)
                if not words:
                    continue
                cuts = range(0, max(1, len(words) - window + 1), step)
                texts = [b" ".join(words[c : c + PIECE_WORDS]).decode() for c in cuts]
                n = [min(PIECE_WORDS, len(words) - c) for c in cuts]
                arrays = [pa.array([item] * len(n), pa.string()), pa.array([len(words) < window] * len(n))]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(n, pa.int64()), pa.array(texts)], ["item", "is_short", "n", "words"])

    return run


_STATE = "doc_id long, n_words long, spans array<struct<start: int, end: int>>, items array<string>"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _scan(automaton, carry: bool):
    """Adds what one automaton finds; with ``carry`` the text goes on to the next pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(automaton.value)
        for batch in batches:
            before = batch.num_columns > 2
            spans = batch.column(3).to_pylist() if before else [None] * batch.num_rows
            items = batch.column(4).to_pylist() if before else [None] * batch.num_rows
            n_words, all_spans, all_items = [], [], []
            for raw, old_spans, old_items in zip(raw_texts(batch.column(1)), spans, items):
                words = term_list(raw)
                hit = np.zeros(len(words), bool)
                for span in old_spans or ():
                    hit[span["start"] : span["end"]] = True
                states = matcher.find(words, hit)
                listed = set(old_items or ())
                for state in states:
                    listed.update(automaton.value.items[state])
                edges = np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))) if hit.any() else np.zeros(0, np.int8)
                begin, end = np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()
                n_words.append(len(words))
                all_spans.append([{"start": a, "end": b} for a, b in zip(begin, end)])
                all_items.append(sorted(listed))
            found = [pa.array(n_words, pa.int64()), pa.array(all_spans, pa.list_(_SPAN)), pa.array(all_items, pa.list_(pa.string()))]
            if carry:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], ["doc_id", "text", "n_words", "spans", "items"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), *found], ["doc_id", "n_words", "spans", "items"])

    return run


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    with_text: bool = False,
) -> DataFrame:
    """doc_id, (text,) n_words, spans of hit words (start, end as word numbers from 0, end
    exclusive, disjoint, ascending) and the items with occurring windows, sorted as strings."""
    spark = docs.sparkSession
    ship_code(spark)
    tests = benchmark.select(benchmark[item_col].cast("string").alias("item"), benchmark["text"].alias("text"))
    pieces = tests.mapInArrow(_pieces(window), "item string, is_short boolean, n long, words string")
    pieces = written(pieces.dropDuplicates(["item", "words"]), "decontamination-items")
    shards = max(1, ceil((pieces.agg(F.sum("n")).first()[0] or 0) / shard_words))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(shards)).cast("int"))

    state = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    for shard in range(shards):
        last = shard == shards - 1
        rows = pieces.filter(F.col("shard") == shard).select("item", "is_short", "words").collect()  # about shard_words words
        automaton = build_automaton([(r["item"], r["is_short"], r["words"].encode().split()) for r in rows], window)
        carry = with_text or not last
        schema = _STATE.replace("doc_id long,", "doc_id long, text string,") if carry else _STATE
        state = state.mapInArrow(_scan(spark.sparkContext.broadcast(automaton), carry), schema)
        if not last:
            state = written(state, "decontamination-pass")
    return state


def _without_spans(max_coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for raw, n, spans in zip(raw_texts(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                n_hit = sum(s["end"] - s["start"] for s in spans)
                if raw is None or not n_hit:
                    texts.append(raw)
                elif n_hit > max_coverage * n:
                    texts.append(b"")
                else:
                    at = [m.span() for m in TERM.finditer(raw)]
                    parts, done = [], 0
                    for s in spans:
                        parts.append(raw[done : at[s["start"]][0]])
                        done = at[s["end"] - 1][1]
                    texts.append(b"".join(parts) + raw[done:])
            arrays = [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text"])

    return run


def remove_contamination(docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5, **options) -> DataFrame:
    """doc_id and text without the hit spans (from a span's first word to its last, with what
    stands between); a text with a larger share of hit words than ``max_coverage`` becomes empty."""
    found = find_contamination(docs, benchmark, with_text=True, **options)
    rows = found.select("doc_id", "text", "n_words", "spans")
    return rows.mapInArrow(_without_spans(max_coverage), "doc_id long, text string")
