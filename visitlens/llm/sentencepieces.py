"""SentencePiece encoding and decoding as shortest paths through a weighted transducer.

A model file is compiled into

* the normaliser: white-space rules (dummy prefix, collapsing, space to U+2581);
* the lexicon: a trie over characters whose leaves emit piece ids, with a self-loop that
  turns a character outside the vocabulary into its UTF-8 bytes' pieces (byte fallback) or
  into the unknown piece;
* arc weights in the tropical semiring.  Unigram models weigh a piece by minus its score.
  In BPE models every piece weighs 0, but a piece may only follow another when the merges,
  applied to the two together, give exactly these two: all other arcs weigh infinity.  A
  sequence whose neighbours all agree in this way is the one greedy merging gives, so the
  one path of finite weight is the BPE segmentation.

An input is composed with it symbol by symbol, and the path of least weight is taken.  No
piece spans a pair of bytes that occurs in no piece, so texts are cut there first; equal
segments of a batch are solved once, and solved segments stay in a bounded memory of the
worker (``MEMORY``), which changes the cost only.

Not supported, and refused: models with precompiled character maps, user-defined or unused
pieces, or white space as suffix.

Defined results: a null text has null ids and an empty one no ids; a text that holds U+2581
decodes to a space in its place, as in the public library, and is then no round trip; rows
are encoded one by one, so repeated rows repeat their result; null lists decode to null, ids
outside the vocabulary raise an error; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .tables import ship_code
from .words import IS_LEAD, byte_view

SPACE = "▁"
SLICE = 1 << 20
MEMORY = 100_000  # segments, and pairs of pieces, a worker remembers
UNKNOWN_PENALTY = 10.0
# Piece types and model types of the public model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
        yield tag >> 3, raw[at : at + size]
        at += size


class PieceModel:
    """A compiled model."""

    def __init__(self, raw: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        trainer: dict[int, object] = {}
        normaliser: dict[int, object] = {}
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        self.bpe = {UNIGRAM: False, BPE: True}.get(trainer.get(3, UNIGRAM))
        refused = self.bpe is None or normaliser.get(2) or trainer.get(24) or not normaliser.get(5, 1)
        if refused or {USER_DEFINED, UNUSED} & set(self.types):
            raise ValueError("only unigram and BPE models without character maps, user-defined or unused pieces")
        self.dummy_prefix, self.collapse = bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1))
        self.byte_fallback = bool(trainer.get(35, 0))
        self.unknown = self.types.index(UNKNOWN)
        self.bytes = {int(p[3:-1], 16): k for k, (p, kind) in enumerate(zip(self.pieces, self.types)) if kind == BYTE}
        self.ids = {p: k for k, (p, kind) in enumerate(zip(self.pieces, self.types)) if kind == NORMAL}
        self.unknown_weight = UNKNOWN_PENALTY - min((self.scores[k] for k in self.ids.values()), default=0.0)
        #: the trie: character -> [what may follow, id of the piece that ends here or None]
        self.lexicon: dict[str, list] = {}
        self.joined = np.zeros((256, 256), bool)  # byte pairs inside a piece, U+2581 as a space
        for piece, k in self.ids.items():
            following, node = self.lexicon, [None, None]
            for c in piece:
                node = following.setdefault(c, [{}, None])
                following = node[0]
            node[1] = k
            b = np.frombuffer(piece.replace(SPACE, " ").encode(), np.uint8)
            self.joined[b[:-1], b[1:]] = True
        self.solved: dict[bytes, bytes] = {}
        self.agreed: dict[int, dict[int, bool]] = {}
        self.n_agreed = 0
        self.built: dict[int, tuple | None] = {}
        output = [self._output(k) for k in range(len(self.pieces))]
        self.out_size = np.array([len(o) for o in output])
        self.out_bytes = np.frombuffer(b"".join(output), np.uint8)

    def _output(self, k: int) -> bytes:
        kind, piece = self.types[k], self.pieces[k]
        if kind == CONTROL:
            return b""
        if kind == BYTE:
            return bytes([int(piece[3:-1], 16)])
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(SPACE, " ").encode()

    # -- the transducer ---------------------------------------------------------------

    def merges(self, piece: int) -> tuple[str, str, list[tuple[float, str, str]]] | None:
        """How greedy merging (best score first, then leftmost) builds a piece: its first and
        last symbol, and after every merge its score and the first and last symbol then.
        None if merging does not end in the piece."""
        if piece not in self.built:
            parts, steps = list(self.pieces[piece]), []
            first, last = parts[0], parts[-1]
            while len(parts) > 1:
                pairs = [self.ids.get(x + y) for x, y in zip(parts, parts[1:])]
                best = max((k for k in pairs if k is not None), key=lambda k: self.scores[k], default=None)
                if best is None:
                    break
                at = next(i for i, k in enumerate(pairs) if k is not None and self.scores[k] == self.scores[best])
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                steps.append((self.scores[best], parts[0], parts[-1]))
            self.built[piece] = (first, last, steps) if len(parts) == 1 else None
        return self.built[piece]

    def agreed_after(self, before: int) -> dict[int, bool]:
        """What is known so far of ``agree(before, piece)``, by piece."""
        if self.n_agreed >= 2 * MEMORY:
            self.agreed.clear()
            self.n_agreed = 0
        return self.agreed.setdefault(before, {})

    def agree(self, before: int, piece: int) -> bool:
        """Whether ``piece`` may follow ``before`` (below 0: nothing, or a character outside
        the vocabulary, with which nothing merges): whether no merge across their border
        comes up while greedy merging builds the two."""
        found = self.agreed_after(before)[piece] = self._apart(before, piece)
        self.n_agreed += 1
        return found

    def _apart(self, before: int, piece: int) -> bool:
        right = self.merges(piece)
        if before < 0 or right is None:
            return right is not None
        _, end, left_steps = self.merges(before)  # it is on a path, so it can be built
        begin, _, right_steps = right
        i = j = 0
        none = float("-inf")
        while True:
            left_next = left_steps[i][0] if i < len(left_steps) else none
            right_next = right_steps[j][0] if j < len(right_steps) else none
            across = self.ids.get(end + begin)
            # of equal scores the leftmost merges first: inside before, across, inside piece
            if across is not None and self.scores[across] > left_next and self.scores[across] >= right_next:
                return False
            if left_next == right_next == none:
                return True
            if left_next >= right_next:
                end, i = left_steps[i][2], i + 1
            else:
                begin, j = right_steps[j][1], j + 1

    def shortest(self, text: str) -> list[int]:
        """Ids on the path of least weight through the composition with ``text``."""
        last, start = self._forward_bpe(text) if self.bpe else self._forward_unigram(text)
        path, at = [], len(text)
        while at:
            path.append((last[at], text[start[at] : at]))
            at = start[at]
        ids: list[int] = []
        for k, part in reversed(path):
            if k >= 0:
                ids.append(k)
            elif self.byte_fallback:
                ids.extend(self.bytes[b] for b in part.encode())
            else:
                ids.append(self.unknown)
        return ids

    def _forward_bpe(self, text: str) -> tuple[list[int], list[int]]:
        """For every place the last piece of the path to it (-1: a character outside the
        vocabulary, -2: no path) and where that piece starts.

        A state of the composition is a place and the last piece.  All weights are 0 or
        infinite, and greedy merging of a prefix is unique, so one state a place is live."""
        n = len(text)
        last, start = [-2] * (n + 1), [0] * (n + 1)
        last[0] = -1
        for i in range(n):
            before = last[i]
            if before == -2:
                continue
            after = self.agreed_after(before)
            following, j = self.lexicon, i
            while j < n:
                node = following.get(text[j])
                if node is None:
                    break
                following, k = node
                j += 1
                if k is not None:
                    follows = after.get(k)
                    if self.agree(before, k) if follows is None else follows:
                        last[j], start[j] = k, i
            if last[i + 1] == -2 and text[i] not in self.ids:
                last[i + 1], start[i + 1] = -1, i
        return last, start

    def _forward_unigram(self, text: str) -> tuple[list[int], list[int]]:
        """The same where pieces have weights: a state is a place, its weight the least one."""
        n, far, scores = len(text), float("inf"), self.scores
        weight, last, start = [0.0] + [far] * n, [-1] * (n + 1), [0] * (n + 1)
        for i in range(n):
            following, j = self.lexicon, i
            while j < n:
                node = following.get(text[j])
                if node is None:
                    break
                following, k = node
                j += 1
                if k is not None and weight[i] - scores[k] < weight[j]:
                    weight[j], last[j], start[j] = weight[i] - scores[k], k, i
            if text[i] not in self.ids and weight[i] + self.unknown_weight < weight[i + 1]:
                weight[i + 1], last[i + 1], start[i + 1] = weight[i] + self.unknown_weight, -1, i
        return last, start

    # -- batches ----------------------------------------------------------------------

    def normalised(self, texts: pa.Array) -> pa.Array:
        if pc.any(pc.match_substring(texts, SPACE)).as_py():
            texts = pc.replace_substring(texts, SPACE, " ")
        if self.collapse:
            texts = pc.utf8_trim(pc.replace_substring_regex(texts, " +", " "), " ")
        return texts

    def encode(self, texts: pa.Array) -> pa.Array:
        """Lists of ids; null for null."""
        parts = []
        data, offsets, null = byte_view(self.normalised(texts))
        lo, n = 0, len(offsets) - 1
        while lo < n:
            hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE, "right")) - 1))
            parts.append(self._encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], null[lo:hi]))
            lo = hi
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    def _encode(self, data: np.ndarray, offsets: np.ndarray, null: np.ndarray) -> pa.Array:
        size = np.diff(offsets)
        full = size > 0
        if self.dummy_prefix:
            data = np.insert(data, offsets[:-1][full], 32)
            size = size + full
        begin = np.cumsum(size) - size
        cut = np.ones(len(data), bool)
        if len(data):
            cut[1:] = ~self.joined[data[:-1], data[1:]] & IS_LEAD[data[1:]]
            cut[begin[full]] = True
        at = np.flatnonzero(cut)
        edges = np.append(at, len(data)).astype(np.int64)
        segments = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])
        coded = segments.dictionary_encode()
        solved = [self._segment(s) for s in coded.dictionary.to_pylist()]
        flat, gathered = _ragged([len(s) // 4 for s in solved], coded.indices.to_numpy(zero_copy_only=False))
        ids = np.frombuffer(b"".join(solved), np.int32)[flat]
        per_text = np.bincount(np.searchsorted(begin[full], at, "right") - 1, gathered, int(full.sum()))
        counts = np.zeros(len(size), np.int64)
        counts[full] = per_text.astype(np.int64)
        if not self.byte_fallback:  # neighbouring unknown characters are one piece
            text = np.repeat(np.arange(len(size)), counts)
            again = np.zeros(len(ids), bool)
            again[1:] = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown) & (text[1:] == text[:-1])
            ids, counts = ids[~again], np.bincount(text[~again], minlength=len(size))
        return pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(ids), mask=pa.array(null)
        )

    def _segment(self, segment: bytes) -> bytes:
        """The segment's ids, packed."""
        found = self.solved.get(segment)
        if found is None:
            found = array("i", self.shortest(segment.decode().replace(" ", SPACE))).tobytes()
            if len(self.solved) >= MEMORY:
                self.solved.clear()
            if len(segment) <= 256:
                self.solved[segment] = found
        return found

    def decode(self, lists: pa.Array) -> pa.Array:
        """Texts of lists of ids; null for null."""
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.pieces)):
            raise ValueError("an id is outside the vocabulary")
        flat, size = _ragged(self.out_size, ids)
        data = self.out_bytes[flat]
        edge = np.concatenate(([0], np.cumsum(size)))
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        edge = edge[np.concatenate(([0], np.cumsum(counts)))]
        valid = lists.is_valid().to_numpy(zero_copy_only=False)
        out: list[str | None] = []
        for a, b, ok in zip(edge[:-1], edge[1:], valid, strict=True):
            a += self.dummy_prefix and b > a and data[a] == 32
            out.append(data[a:b].tobytes().decode("utf-8", "replace") if ok else None)
        return pa.array(out, pa.string())


def _ragged(sizes, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the concatenated rows of a ragged table that spell the rows ``codes``; the
    sizes of these rows."""
    sizes = np.asarray(sizes, np.int64)
    first = np.cumsum(sizes) - sizes
    size = sizes[codes] if len(codes) else np.empty(0, np.int64)
    skip = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat((first[codes] if len(codes) else size) - skip, size), size


@lru_cache(maxsize=2)
def compiled(raw: bytes) -> PieceModel:
    return PieceModel(raw)


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces, pieces (ids) and round_trip (the ids decode to the text) of every row."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())  # the model file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = compiled(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = model.encode(part.column(1))
                same = pc.equal(model.decode(ids), part.column(1).cast(pa.string()))
                n = pc.list_value_length(ids).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), n, ids, same], ["doc_id", "n_pieces", "pieces", "round_trip"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pieces long, pieces array<int>, round_trip boolean")


def decode_pieces(encoded: DataFrame, model_path: str, id_col: str = "doc_id", pieces_col: str = "pieces") -> DataFrame:
    """doc_id and text of every row."""
    ship_code(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = compiled(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), model.decode(part.column(1))], ["doc_id", "text"])

    rows = encoded.select(encoded[id_col].cast("long").alias("doc_id"), encoded[pieces_col].cast("array<int>").alias("pieces"))
    return rows.mapInArrow(run, "doc_id long, text string")
