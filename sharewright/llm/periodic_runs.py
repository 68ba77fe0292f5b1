"""Periodic runs of words (maximal repetitions) found with suffix trees, and texts collapsed to one period of each run.

Each text is one sequence of words, handled by one task. Ukkonen's algorithm builds the suffix tree of the sequence and of
its reversal. An Euler tour of each tree with a sparse table of minima answers "how far do the suffixes at i and j agree"
in constant time (the string depth of the lowest common ancestor). The longest Lyndon word at every position, in the order
of the words and in the reversed order, is a possible root of a run; each root is extended to both sides by these queries.
By the runs theorem every run has such a root in one of the two orders, so no run is missed.

Trees are built only for stretches that can hold a run: in a run of period q every word after the first q occurs again
within q words, so a long enough stretch of near recurrences is a necessary condition. It is tested for all powers of two.

Null or wordless text: no words, no runs, empty collapsed text. Null doc_ids and repeated rows are handled row by row. Very
long texts: memory grows with the longest stretch that can hold a run. Extra columns are ignored; empty tables give an
empty result.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MIN_EXPONENT, MIN_LENGTH = 4, 6
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_ARROW_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class SuffixTree:
    """Ukkonen's suffix tree of a list of integers from 0, closed by a sentinel that is smaller than all of them."""

    def __init__(self, symbols: list[int]):
        s = [*symbols, -1]
        n = len(s)
        start, end, link = [0], [0], [0]
        kids: list[dict[int, int] | None] = [{}]
        node = edge = length = waiting = 0
        for i, c in enumerate(s):
            waiting += 1
            fresh = 0                                   # internal node that still needs its suffix link
            while waiting:
                if not length:
                    edge = i
                child = kids[node].get(s[edge])
                if child is None:
                    kids[node][s[edge]] = len(start)
                    start.append(i), end.append(n), link.append(0), kids.append(None)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    size = end[child] - start[child]
                    if length >= size:
                        node, edge, length = child, edge + size, length - size
                        continue
                    middle = start[child] + length
                    if s[middle] == c:
                        length += 1
                        if fresh:
                            link[fresh] = node
                        break
                    split = len(start)
                    start.append(start[child]), end.append(middle), link.append(0), kids.append({s[middle]: child, c: split + 1})
                    start.append(i), end.append(n), link.append(0), kids.append(None)
                    kids[node][s[edge]] = split
                    start[child] = middle
                    if fresh:
                        link[fresh] = split
                    fresh = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.size, self.start, self.end, self.kids = n, start, end, kids

    def euler_tour(self) -> tuple[np.ndarray, np.ndarray]:
        """String depths met on the tour, and the place in it of the leaf of each suffix."""
        start, end, kids, n = self.start, self.end, self.kids, self.size
        tour: list[int] = []
        places = [0] * n
        stack: list[tuple[int, int]] = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            below = kids[node] if node >= 0 else None
            if below is None:
                if node >= 0:
                    places[n - depth] = len(tour)
                tour.append(depth)
                continue
            tour.append(depth)
            for symbol in sorted(below, reverse=True):
                child = below[symbol]
                stack.append((-1, depth))               # back at this node after the child
                stack.append((child, depth + end[child] - start[child]))
        return np.array(tour, dtype=np.int32), np.array(places, dtype=np.int64)

    def ranks(self, reverse: bool) -> list[int]:
        """Rank of each suffix in the order of the symbols or of the reversed symbols; a prefix is smaller in both."""
        start, end, kids, n = self.start, self.end, self.kids, self.size
        out, rank = [0] * n, 0
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            below = kids[node]
            if below is None:
                out[n - depth] = rank
                rank += 1
                continue
            order = sorted(below, reverse=not reverse)
            if reverse and order[0] == -1:
                order = [*order[1:], -1]
            for symbol in order:                        # the last pushed, the sentinel if there is one, comes first
                child = below[symbol]
                stack.append((child, depth + end[child] - start[child]))
        return out


class Extensions:
    """Longest common extensions of two positions in constant time each, many at once."""

    def __init__(self, tree: SuffixTree):
        tour, self.places = tree.euler_tour()
        self.tables = [tour]
        while (half := 1 << (len(self.tables) - 1)) * 2 <= len(tour):
            last = self.tables[-1]
            self.tables.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.places[i], self.places[j]
        a, b = np.minimum(a, b), np.maximum(a, b) + 1
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), dtype=np.int64)
        for k in np.unique(level):
            at, table = level == k, self.tables[k]
            out[at] = np.minimum(table[a[at]], table[b[at] - (1 << int(k))])
        return out


def _lyndon_lengths(ranks: list[int], n: int) -> np.ndarray:
    """Length of the longest Lyndon word at each position: up to the next smaller suffix."""
    out, stack = [0] * n, []
    for i in range(n):
        r = ranks[i]
        while stack and ranks[stack[-1]] > r:
            j = stack.pop()
            out[j] = i - j
        stack.append(i)
    for j in stack:
        out[j] = n - j
    return np.array(out, dtype=np.int64)


def runs_of(symbols: list[int], exponent: int = 2, shortest: int = 2) -> set[tuple[int, int, int]]:
    """(start, length, period) of every run with length >= max(shortest, exponent * period); exponent is 2 at least."""
    n = len(symbols)
    if n < shortest:
        return set()
    tree = SuffixTree(symbols)
    right, left = Extensions(tree), Extensions(SuffixTree(symbols[::-1]))
    found: set[tuple[int, int, int]] = set()
    for reverse in (False, True):
        period = _lyndon_lengths(tree.ranks(reverse), n)
        i = np.flatnonzero(period * exponent <= n)
        p = period[i]
        # position n is the sentinel in both trees
        ahead = right(i, i + p)
        behind = left(n - i, n - i - p)
        length = behind + p + ahead
        keep = (length >= exponent * p) & (length >= shortest)
        found.update(zip((i - behind)[keep].tolist(), length[keep].tolist(), p[keep].tolist()))
    return found


def _stretches(gaps: np.ndarray, exponent: int, shortest: int) -> list[tuple[int, int]]:
    """Disjoint intervals of positions; every run asked for lies wholly in one of them. gaps: distance to the last
    occurrence of the same word."""
    n, out, low = len(gaps), [], 1
    while low * exponent <= n:
        high = 2 * low - 1                              # periods from low to high
        bad = np.concatenate(([-1], np.flatnonzero(gaps > high), [n]))
        room = np.diff(bad) - 1
        for k in np.flatnonzero(room >= max((exponent - 1) * low, shortest - high)):
            out.append((max(0, int(bad[k]) - high), int(bad[k + 1])))
        low *= 2
    merged: list[tuple[int, int]] = []
    for a, b in sorted(out):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def runs_of_words(words: list[bytes], exponent: int = MIN_EXPONENT, shortest: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """Runs of a text's words by start, then period."""
    last: dict[bytes, int] = {}
    gaps, far = [], -len(words) - 1
    for i, w in enumerate(words):
        gaps.append(i - last.get(w, far))
        last[w] = i
    found: list[tuple[int, int, int]] = []
    for a, b in _stretches(np.array(gaps, dtype=np.int64), exponent, shortest):
        ids: dict[bytes, int] = {}
        symbols = [ids.setdefault(w, len(ids)) for w in words[a:b]]
        found += [(a + s, length, p) for s, length, p in runs_of(symbols, exponent, shortest)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, dtype=np.int32)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]


def find_runs(docs: DataFrame, exponent: int = MIN_EXPONENT, shortest: int = MIN_LENGTH,
              prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs by start then period, and the collapsed text (kept words joined by one space).

    Words are maximal stretches without space, tab, line feed, vertical tab, form feed and carriage return. `prepare` may
    change the words of a document before it is searched.
    """
    def search(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            counts, runs, left = [], [], []
            for doc_id, text in zip(ids, texts):
                words = (text.as_py() or b"").split()
                if prepare:
                    words = prepare(doc_id, words)
                found = runs_of_words(words, exponent, shortest)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                left.append(b" ".join(collapse(words, found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, _ARROW_RUNS),
                 pa.array(left, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(search, SCHEMA)
