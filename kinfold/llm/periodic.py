"""Runs of words that repeat with a period (operator 13): suffix-tree longest common extensions.

A run is a longest stretch of words with smallest period q (words q apart are equal) and at least ``max(shortest, 2 * q)``
words. Every run is found by its Lyndon roots: for one of the two orders of the words, the longest Lyndon word at some
position of the run is a period of it. It ends where the next smaller (or next greater) suffix begins. Each such candidate is
extended to the right and to the left by longest common extensions. These come in constant time from two suffix trees,
of the words and of their reversal, which Ukkonen's algorithm builds: the common prefix of two suffixes is as long as the
lowest node between their leaves is deep, on an Euler tour of the tree, and a table of range minima answers that.

Trees are built over the parts of a text that can hold a run. Every word of a run of ``shortest`` words lies in a window
of half that length that occurs again in the run, one period away, and a period is at most half of the run. Stretches covered by
such windows therefore hold all runs whole; most texts have none. The windows are compared exactly.

Each text is searched in the task that reads it: no shuffle, no table in memory. A text needs some hundred bytes for each word of
its longest periodic part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import parts
from .words import covered, window_numbers, word_numbers

Rewrite = Callable[[str, list[bytes]], list[bytes]]


def suffix_tree(word: list[int]) -> tuple[list[int], list[int], dict[int, int], list[int]]:
    """Ukkonen's tree of ``word``, whose last symbol occurs once.

    (begin of each edge, its end, child by node * (largest symbol + 1) + first symbol of the edge, suffix of each leaf or -1);
    the edge of a node leads to it, node 0 is the root.
    """
    n, base = len(word), max(word) + 1
    begin, end, link, suffix, child = [0], [0], [0], [-1], {}
    node = edge = length = open_suffixes = 0
    for i, symbol in enumerate(word):
        waiting = 0
        open_suffixes += 1
        while open_suffixes:
            if not length:
                edge = i
            key = node * base + word[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(begin)
                begin.append(i)
                end.append(n)
                link.append(0)
                suffix.append(i - open_suffixes + 1)
                if waiting:
                    link[waiting] = node
                    waiting = 0
            else:
                first = begin[below]
                size = end[below] - first
                if length >= size:  # walk down
                    edge += size
                    length -= size
                    node = below
                    continue
                if word[first + length] == symbol:
                    length += 1
                    if waiting:
                        link[waiting] = node
                    break
                inner = len(begin)  # split the edge, hang a leaf on the new node
                begin += (first, i)
                end += (first + length, n)
                link += (0, 0)
                suffix += (-1, i - open_suffixes + 1)
                child[key] = inner
                begin[below] = first + length
                child[inner * base + word[first + length]] = below
                child[inner * base + symbol] = inner + 1
                if waiting:
                    link[waiting] = inner
                waiting = inner
            open_suffixes -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - open_suffixes + 1
    return begin, end, child, suffix


def euler_tour(word: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, depth of the lowest node that the tour visits between each leaf and the one before it)."""
    begin, end, child, suffix = suffix_tree(word)
    keys = np.fromiter(child.keys(), dtype=np.int64, count=len(child))
    order = np.argsort(keys)
    parent = keys[order] // (max(word) + 1)
    below = np.fromiter(child.values(), dtype=np.int64, count=len(child))[order].tolist()
    first = np.searchsorted(parent, np.arange(len(begin) + 1)).tolist()
    leaves, lowest = [], []
    turn, stack = 0, [(0, 0)]
    turned = False
    while stack:
        node, depth = stack.pop()
        if turned:  # the tour came back up to the parent, at ``depth``, and goes down again
            turn, turned = depth, False
        if suffix[node] >= 0:
            leaves.append(suffix[node])
            lowest.append(turn)
            turned = True
        else:
            depth += end[node] - begin[node]
            for at in range(first[node + 1] - 1, first[node] - 1, -1):
                stack.append((below[at], depth))
    return np.array(leaves, dtype=np.int64), np.array(lowest, dtype=np.int64)


class Extensions:
    """Longest common prefixes of any two suffixes of ``ids`` (numbers from 1), in constant time."""

    def __init__(self, ids: np.ndarray) -> None:
        self.n = len(ids)
        self.leaves, lowest = euler_tour([*ids.tolist(), 0])
        self.rank = np.empty(self.n + 1, dtype=np.int64)
        self.rank[self.leaves] = np.arange(self.n + 1)
        self.table = [lowest.astype(np.int32)]
        while 2 << (len(self.table) - 1) <= len(lowest):
            half, last = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b`` (different positions, 0 to n)."""
        lo, hi = np.minimum(self.rank[a], self.rank[b]) + 1, np.maximum(self.rank[a], self.rank[b])
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), dtype=np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.table[k][lo[at]], self.table[k][hi[at] - (1 << int(k)) + 1])
        return out


def next_smaller(rank: list[int]) -> list[int]:
    """For each position the next one with a smaller rank (the length if there is none)."""
    out, stack = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def all_runs(ids: np.ndarray, shortest: int) -> np.ndarray:
    """Rows (start, length, period) of all runs of ``ids``, sorted."""
    n = len(ids)
    ids = np.unique(ids, return_inverse=True)[1].reshape(-1) + 1
    right = Extensions(ids)
    at = np.arange(n)
    found = []
    for rank in (right.rank, -right.rank):  # the order of the words, and the opposite one
        period = np.array(next_smaller(rank.tolist())[:n]) - at
        i = at[at + period < n]  # a root that reaches the end, or the end mark, repeats nothing
        found.append(np.stack([i, period[i]], axis=1))
    roots = np.concatenate(found)
    i, p = roots[:, 0], roots[:, 1]
    after = right.common(i, i + p)
    del right
    left = Extensions(ids[::-1])
    before = np.zeros(len(i), dtype=np.int64)
    inner = np.flatnonzero(i > 0)
    before[inner] = left.common(n - i[inner], n - i[inner] - p[inner])
    length = p + after + before
    runs = np.stack([i - before, length, p], axis=1)[length >= np.maximum(shortest, 2 * p)]
    return np.unique(runs, axis=0)


def periodic_parts(ids: np.ndarray, shortest: int) -> list[tuple[int, int]]:
    """Stretches (start, end) that hold every run whole: covered by windows that occur again near enough."""
    n, size = len(ids), shortest // 2
    windows = window_numbers(ids, size)
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    gap = np.where(same, order[1:] - order[:-1], n)
    near = np.full(len(windows), n)  # distance to the nearest equal window
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    starts = np.flatnonzero(near < n)
    while len(starts):
        edges = np.flatnonzero(np.diff(covered(starts, size, n).astype(np.int8), prepend=0, append=0))
        begins, ends = edges[::2], edges[1::2]
        width = (ends - begins)[np.searchsorted(begins, starts, side="right") - 1]
        fits = (width >= shortest) & (2 * near[starts] <= width)
        if fits.all():
            return list(zip(begins.tolist(), ends.tolist(), strict=True))
        starts = starts[fits]
    return []


def runs_of(ids: np.ndarray, shortest: int = 12) -> np.ndarray:
    """Rows (start, length, period) of the runs of a sequence of numbers, by start, then period."""
    found = []
    if len(ids) >= shortest:
        for a, b in periodic_parts(ids, shortest):
            runs = all_runs(ids[a:b], shortest)
            runs[:, 0] += a
            found.append(runs)
    runs = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """``words`` without those that a run contains after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 12, rewrite: Rewrite | None = None,
              digests: bool = False) -> DataFrame:
    """The runs of every text, one row for each row of ``df``.

    Words are maximal stretches without white space (0x20, 0x09 to 0x0D). The result has the id, n_words, n_runs, the
    longest run (start, length, period, exponent_milli = floor(1000 * length / period); ties: smallest start, then period; NULL
    without a run), runs (``start,length,period`` and a line feed for each, by start, then period) and collapsed (the words that no
    run contains after its first period, joined by one space). With ``digests`` the last two are the lower-case
    SHA-256 of those texts, so that no text leaves the task.

    ``rewrite`` is an optional function of (id as text, words) that gives the words to search. NULL and empty texts have no
    words, no run and an empty collapsed text; a NULL id is the empty text for ``rewrite``. Repeated ids and texts are judged row by
    row; an empty table gives an empty result. Other columns of ``df`` are not read.
    """
    if shortest < 2 or shortest % 2:
        raise ValueError("the shortest run must be an even number of words")
    rows = df.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"))
    kind = rows.schema[0].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
              f"{'runs_sha256 string, collapsed_sha256 string' if digests else 'runs string, collapsed string'}")
    names = [id_col, *[c.split()[0] for c in schema.split(", ")[1:]]]

    def written(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest() if digests else data.decode()

    def judged(name: str, text: str | None) -> tuple:
        words = (text or "").encode().split()
        if rewrite is not None:
            words = rewrite(name, words)
        ids, different = word_numbers(words)
        runs = runs_of(ids, shortest) if different < len(ids) else np.zeros((0, 3), dtype=np.int64)
        best = [None] * 4
        if len(runs):
            start, length, period = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2]))
            best = [start, length, period, 1000 * length // period]
        listed = "".join(f"{a},{size},{q}\n" for a, size, q in runs.tolist()).encode()
        return len(words), len(runs), *best, written(listed), written(b" ".join(collapsed(words, runs)))

    def scan(batches):
        for part in parts(batches):
            found = [judged(i, t) for i, t in zip(part.column(2).to_pylist(), part.column(1).to_pylist(), strict=True)]
            columns = list(zip(*found, strict=True))
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.record_batch([part.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=names)

    return rows.mapInArrow(scan, schema)
