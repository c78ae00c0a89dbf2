"""Plain single-machine versions of the operators, for comparison."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def cut_passages(docs: dict[int, str | None], window: int = 50) -> dict[int, tuple]:
    ws = {d: words(t) for d, t in docs.items()}
    first: dict[tuple, int] = {}
    for d in sorted(ws):
        for i in range(len(ws[d]) - window + 1):
            first.setdefault(tuple(ws[d][i : i + window]), d)
    out = {}
    for d, w in ws.items():
        gone: set[int] = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def labels_of(nodes, links) -> dict:
    low = {n: n for n in nodes}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        low[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def near_documents(docs: dict[int, str | None], k: int = 5, percent: int = 75) -> dict[int, tuple]:
    sets = {}
    for d, t in docs.items():
        w = words((t or "").translate(LOWER))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    both: Counter = Counter()
    for ds in holders.values():
        both.update((ds[i], ds[j]) for i in range(len(ds)) for j in range(i))
    links = [(a, b) for (a, b), n in both.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    low = labels_of(sets, links)
    return {d: (len(sets[d]), low[d], low[d] == d) for d in sets}


def near_vectors(ids: list[int], x: np.ndarray, threshold: float = 0.9) -> dict[int, tuple]:
    norm = np.sqrt((x * x).sum(1))
    links = (x @ x.T) / (norm[:, None] * norm[None, :]) >= threshold
    np.fill_diagonal(links, False)
    low = labels_of(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(links)) if i < j])
    return {d: (int(n), low[d], low[d] == d) for d, n in zip(ids, links.sum(1))}


def repetition_base(text: str | None) -> tuple:
    w = words(text)
    found = defaultdict(list)
    for i in range(len(w) - 2):
        found[tuple(w[i : i + 3])].append(i)
    covered = {j for at in found.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, dup, len(covered), failed


def repetition_shares(text: str | None, top: dict, dup: dict) -> dict[str, float]:
    """Shares of word characters in repeated n-grams, n-gram by n-gram."""
    w = words(text)
    total = max(1, sum(map(len, w)))
    out = {}
    for n in top:
        grams = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        most = max((c * sum(map(len, g)) for g, c in grams.items() if c > 2), default=0)
        out[f"top_{n}gram_share"] = min(1.0, most / total)
    for n in dup:
        seen, covered = set(), set()
        for i in range(len(w) - n + 1):
            g = tuple(w[i : i + n])
            if g in seen:
                covered.update(range(i, i + n))
            seen.add(g)
        out[f"dup_{n}gram_share"] = sum(len(w[i]) for i in covered) / total
    return out


def targets(sizes: dict, weights=(5.0, 2.0, 1.0), share: float = 1.5, cap: float = 2.0) -> dict:
    """Sources in order with their targets, resharing the excess round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ones, left = {}, set(order), share * sum(sizes.values())
    while open_ones:
        total = sum(weight[s] for s in open_ones)
        above = [s for s in open_ones if weight[s] * left / total >= cap * sizes[s]]
        if not above:
            return target | {s: weight[s] * left / total for s in open_ones}
        for s in above:
            target[s] = cap * sizes[s]
            left -= target[s]
            open_ones.discard(s)
    return target
