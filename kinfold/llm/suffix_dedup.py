"""Exact repeated-substring removal by a common-prefix-aware distributed merge sort of suffixes.

A byte is removed if it stands in a string of ``length`` bytes that also starts earlier. Sorting every suffix would
move each byte hundreds of times, so suffixes are **anchored**: of every window of ``length`` bytes, the anchor is the
``KMER``-byte string in it with the smallest hash (the first of equals). Equal windows have their anchor at the same
place, so only windows of anchors with the same string can be equal; there is an anchor every 40 bytes or so.

1. **Anchors.** The hash and place of each anchor are dealt by hash (of equal ones in a task one row, so a frequent string
   is no hot key); anchors whose string stands at one place only are dropped, which leaves about the repeated part of
   the corpus.
2. **Runs.** Next to its text, each repeated anchor becomes the suffix that starts at it, as far as its windows reach,
   followed by what its windows hold before it, backwards. A task sorts its suffixes into runs. Of equal suffixes in
   a run only the first place goes on, since the windows of the others start earlier there: a passage that very many
   documents hold is one suffix in each run.
3. **Exchange.** A run is cut at fixed bounds of the anchor hash (evenly spread, whatever the text) and front-coded:
   each suffix as the length of the prefix that it shares with the one before, and its other bytes.
4. **Merge.** Each range combines its runs with a **loser tree** that keeps, for each run, the length of the prefix
   known to be shared with the last winner: the run that shares more comes first without looking at a byte, and
   only at equal lengths are bytes compared, from that length on. Suffixes come out with their shared prefix with
   the one before, so equal ones and those of one anchor string stand together.
5. **Windows.** Within one anchor string, windows that reach farther than the longest shared prefix with either
   neighbour are single; the others are compared, and all but the first place of each are removed. An anchor string
   with more than ``GROUP`` different suffixes sends its windows to a grouping by the whole window instead.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegralType

from kinfold.operators.joins import checked_broadcast

from .batches import BASE, INVERSE, mixed, parts, powers, slices, span_hashes, written

KMER = 24
#: Text bytes scanned for anchors at once: the arrays stay in the processor's cache.
SCAN_BYTES = 1 << 16
#: Anchors looked at together before they are dealt.
SCAN_ROWS = 400_000
#: Places to which such a lot deals its rows that need not meet others; and the mark of a spot known to be repeated.
LOTS, KNOWN = 64, np.int64(-(1 << 63))
#: Suffixes sorted at once in a task.
RUN = 150_000
#: Text bytes for each range of the merge: bounds what a range has to hold.
RANGE_BYTES = 6 << 20
#: Different suffixes of one anchor string that are compared in memory; up to SMALL_GROUP of them window by window.
GROUP, SMALL_GROUP = 100_000, 400


def documents_of(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """((id, key, row, text), whether ``row`` tells documents apart): documents in the order of (key, row).

    An integer id is the key (NULL: before all others) and ``row`` is 0 unless several rows have that id. Those, and all documents of any other type
    of id, are numbered in the order of id, hash and length of the text: the number is the row. Only repeated ids cost more than a count of
    the ids. Numbers are written, so that they stay as they are when a task runs again.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.col(id_col).alias("id"), text.alias("text"))
    integral = isinstance(docs.schema["id"].dataType, IntegralType)
    key = F.coalesce(F.col("id").cast("long"), F.lit(-(1 << 63))) if integral else F.lit(0).cast("long")
    if integral:
        twice = docs.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k")
        if twice.isEmpty():
            return docs.select("id", key.alias("key"), F.lit(0).cast("long").alias("row"), "text"), False
        some = docs.join(checked_broadcast(written(twice)), key == F.col("k"), "left_semi")
    else:
        some = docs
    mark = [F.xxhash64("text").alias("h"), F.octet_length("text").alias("size")]
    order = [F.col("i").asc_nulls_first(), "h", "size"]
    each = some.select(F.col("id").alias("i"), *mark).distinct()
    # range partitions in order, each sorted: the running number of a row keeps that order
    numbers = written(each.repartitionByRange(*order).sortWithinPartitions(*order).select("i", "h", "size", (F.monotonically_increasing_id() + 1).alias("n")))
    numbers = checked_broadcast(numbers.withColumnsRenamed({"h": "h2", "size": "size2"}))
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("h2")) & (F.col("size") == F.col("size2"))
    return docs.select("*", *mark).join(numbers, same, "left").select("id", key.alias("key"), F.coalesce("n", F.lit(0)).alias("row"), "text"), True


def packed_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with the text's bytes compressed: texts are dealt by id twice, and this is what the shuffles hold."""
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for part in parts(batches):
            texts = part.column(1).cast(pa.binary()).to_pylist()
            heads = part.column(0).flatten()
            yield pa.record_batch([*heads, pa.array([packer.compress(t) for t in texts], type=pa.binary())], names=["id", "key", "row", "packed"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select(F.struct("id", "key", "row").alias("head"), "text").mapInArrow(scan, f"id {kind}, key long, row long, packed binary")


def unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(heads, texts) of record batches (head, packed text), some megabytes at a time."""
    opener = zstandard.ZstdDecompressor()
    for part in parts(batches, 1 << 20):
        yield part.column(0).to_pylist(), [opener.decompress(z) for z in part.column(1).to_pylist()]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i+width] for every i where it fits."""
    span, out = 1, x
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:len(x) - width + 1], out[width - span:len(x) - span + 1]) if span < width else out


def kmer_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of text[i:i+KMER] for every i where it fits (``span_hashes`` of them)."""
    sums = np.zeros(len(text) + 1, dtype=np.uint64)
    terms = text.astype(np.uint64)
    terms += np.uint64(1)
    terms *= powers(BASE, len(text))
    np.cumsum(terms, out=sums[1:])
    h = sums[KMER:] - sums[:-KMER]
    h *= powers(INVERSE, len(text) + 1)[:len(h)]
    return h


def anchors(text: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of the anchors of all texts that are laid end to end in ``text``."""
    none = np.zeros(0, dtype=np.int64)
    if len(text) < length:
        return none.astype(np.uint64), none, none, none
    h = kmer_hashes(text)
    place_bits = np.arange(len(h), dtype=np.uint64)
    least = sliding_min((h & np.uint64(0xFFFFFFFF00000000)) | place_bits, length - KMER + 1)
    windows = np.arange(len(least))
    fits = np.zeros(len(text) + 1, dtype=np.int32)  # windows that end within their text
    sizes = np.diff(begins)
    whole = sizes >= length
    np.add.at(fits, begins[:-1][whole], 1)
    np.add.at(fits, begins[1:][whole] - length + 1, -1)
    windows = windows[np.cumsum(fits)[:len(least)] > 0]
    place = (least[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(place):
        return none.astype(np.uint64), none, none, none
    new = np.concatenate([[True], np.diff(place) != 0])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(place)]]) - 1
    return mixed(h[place[first]]), place[first], windows[first], windows[last]


def packed(place: np.ndarray, before: np.ndarray, more: np.ndarray) -> np.ndarray:
    """One integer: place of the anchor, windows before it and after the first (both of them below 128)."""
    return (place << 7 | before) << 7 | more


def anchor_rows(docs: DataFrame, length: int, numbered: bool, held_rows: int = SCAN_ROWS) -> DataFrame:
    """(deal, key, spot, and row where documents are ``numbered``) of every anchor; rows that must meet have the same ``deal``.

    Anchors are looked at ``held_rows`` at a time: of those with the same hash only the first is dealt by the hash, and the others are
    dealt to ``LOTS`` places of their own; all of them are marked as known to be repeated (a negative spot). So a string
    that stands in very many documents is a row for each such lot, and no task gets all its places.
    """
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for heads, texts in slices(batches, SCAN_BYTES):
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            begins = np.concatenate([[0], np.cumsum(sizes)])
            h, place, low, high = anchors(np.frombuffer(b"".join(texts), dtype=np.uint8), begins, length)
            doc = np.searchsorted(begins, place, side="right") - 1
            names = [np.array([x[c] for x in heads], dtype=np.int64)[doc] for c in (("key", "row") if numbered else ("key",))]
            held.append((h, packed(place - begins[doc], place - low, high - low), *names))
            n += len(h)
            if n >= held_rows:
                yield dealt(held)
                held, n = [], 0
        if n:
            yield dealt(held)

    def dealt(held: list) -> pa.RecordBatch:
        h, spot, key, *row = (np.concatenate(c) for c in zip(*held, strict=True))
        _, first, inverse, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        later = first[inverse] != np.arange(len(h))
        lots = mixed(np.arange(LOTS, dtype=np.uint64) + mixed(key[:1].view(np.uint64) + spot[:1].view(np.uint64)))
        h = np.where(later, lots[np.arange(len(h)) % LOTS], h)
        spot = np.where(count[inverse] > 1, spot | KNOWN, spot)
        return pa.record_batch([pa.array(h.view(np.int64)), pa.array(key), pa.array(spot), *map(pa.array, row)], names=["deal", "key", "spot", "row"][:3 + numbered])

    return docs.select(F.struct("key", "row").alias("head"), "text").mapInArrow(scan, "deal long, key long, spot long" + ", row long" * numbered)


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """(key, row, spot) of the anchors known to be repeated or dealt like another; streams over sorted ``deal``."""
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None  # the last row, whose successor is still to come
        before = None  # the deal before it

        def found(keep: np.ndarray, key: np.ndarray, spot: np.ndarray, *row: np.ndarray) -> pa.RecordBatch:
            of = row[0][keep] if row else np.zeros(int(keep.sum()), dtype=np.int64)
            return pa.record_batch([pa.array(key[keep]), pa.array(of), pa.array(spot[keep] & ~KNOWN)], names=["key", "row", "spot"])

        for batch in batches:
            now = tuple(c.to_numpy() for c in batch.columns)
            if not len(now[0]):
                continue
            if held is not None:
                now = tuple(np.concatenate([a, b]) for a, b in zip(held, now, strict=True))
            deal, spot = now[0], now[2]
            same = deal[1:] == deal[:-1]
            keep = spot < 0
            keep[0] |= before is not None and before == deal[0]
            keep[1:] |= same
            keep[:-1] |= same
            before = deal[-2] if len(deal) > 1 else before
            held = tuple(x[-1:] for x in now)
            if keep[:-1].any():
                yield found(keep[:-1], *(x[:-1] for x in now[1:]))
        if held is not None and (held[2][0] < 0 or before is not None and before == held[0][0]):
            yield found(np.ones(1, dtype=bool), *held[1:])

    return rows.repartition("deal").sortWithinPartitions("deal").mapInArrow(scan, "key long, row long, spot long")


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix; the first ``known`` bytes are known to be equal."""
    size = min(len(a), len(b))
    x, y = a[known:size], b[known:size]
    if x == y:
        return size
    return size - (((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() + 7) >> 3)


def front_coded(entries: list[tuple[bytes, int, int, int, int]]) -> bytes:
    """A sorted run of (suffix, bytes from the anchor on, key, row, place) as one compressed block."""
    shared, tails, last = [], [], b""
    for e in entries:
        n = shared_prefix(last, e[0])
        shared.append(n)
        tails.append(e[0][n:])
        last = e[0]
    columns = [np.array(c, dtype=t).tobytes() for c, t in ((shared, "<u2"), ([len(t) for t in tails], "<u2"), ([e[1] for e in entries], "<u2"), ([e[2] for e in entries], "<i8"), ([e[3] for e in entries], "<i8"), ([e[4] for e in entries], "<i4"))]
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps((len(entries), columns, b"".join(tails))))


class Run:
    """A front-coded run, decoded one suffix at a time."""

    def __init__(self, block: bytes) -> None:
        self.n, columns, self.tails = pickle.loads(zstandard.ZstdDecompressor().decompress(block))
        self.shared, self.sizes, self.ahead, self.keys, self.rows, self.places = (np.frombuffer(c, dtype=t).tolist() for c, t in zip(columns, ("<u2", "<u2", "<u2", "<i8", "<i8", "<i4"), strict=True))
        self.i, self.at, self.suffix = -1, 0, b""

    def advance(self) -> int:
        """Moves to the next suffix; the prefix shared with the one before, or -1 at the end."""
        self.i += 1
        if self.i >= self.n:
            self.suffix = b""
            return -1
        n, size = self.shared[self.i], self.sizes[self.i]
        self.suffix = self.suffix[:n] + self.tails[self.at:self.at + size]
        self.at += size
        return n


def merged(runs: list[Run]) -> Iterator[tuple[int, Run]]:
    """The runs' suffixes in order: (prefix shared with the suffix before, the run that stands at it).

    ``known[i]`` is the prefix that run i's suffix shares with the last suffix put out. A node of the tree keeps the loser of
    its match; the winner's way up is replayed after it moves on.
    """
    width = 1
    while width < len(runs):
        width *= 2
    known = [0] * width
    done = [True] * width
    for i, r in enumerate(runs):
        done[i] = r.advance() < 0
    losers = [0] * width

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix becomes that with the winner."""
        if done[a]:
            return b, a
        if done[b]:
            return a, b
        if known[a] > known[b]:
            return a, b
        if known[b] > known[a]:
            return b, a
        x, y, n = runs[a].suffix, runs[b].suffix, known[a]
        n = shared_prefix(x, y, n)
        if n == len(x) and n == len(y):
            first, second = (a, b) if a < b else (b, a)
        elif n == len(x) or n < len(y) and x[n] < y[n]:
            first, second = a, b
        else:
            first, second = b, a
        known[second] = n
        return first, second

    def build(node: int) -> int:
        if node >= width:
            return node - width
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if width > 1 else 0
    while not done[winner]:
        yield known[winner], runs[winner]
        n = runs[winner].advance()
        done[winner] = n < 0
        known[winner] = max(n, 0)
        node = (winner + width) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def suffix_runs(joined: DataFrame, length: int, ranges: int) -> DataFrame:
    """(part, block): front-coded pieces of sorted runs (part >= 0), and the spans of equal suffixes in a run (part < 0)."""
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: list[tuple[bytes, int, int, int, int]] = []
        for heads, texts in unpacked(batches):
            for head, text in zip(heads, texts, strict=True):
                spots = np.unique(np.array(head["spots"], dtype=np.int64))
                place, before, more = (spots >> 14) & 0x7FFFFFFF, (spots >> 7) & 127, spots & 127
                buffer = np.frombuffer(text, dtype=np.uint8)
                hashes = mixed(span_hashes(buffer, place, place + KMER)).astype(">u8").tobytes()
                for i, (a, b, m) in enumerate(zip(place.tolist(), before.tolist(), more.tolist(), strict=True)):
                    ahead = text[a:a - b + m + length]
                    entries.append((hashes[8 * i:8 * i + 8] + ahead + text[a - b:a][::-1], len(ahead), head["key"], head["row"], a))
                if len(entries) >= RUN:
                    yield from flushed(entries)
                    entries = []
        if entries:
            yield from flushed(entries)

    def flushed(entries: list) -> Iterator[pa.RecordBatch]:
        entries.sort()
        parts: dict[int, list] = {}
        spans: list[tuple[int, int, int, int]] = []
        last: tuple = ()
        for e in entries:
            if last and e[0] == last[0] and e[1] == last[1]:
                if e[2:] != last[2:]:
                    spans.append(whole_span(e))
                continue
            last = e
            parts.setdefault(int.from_bytes(e[0][:8], "big") * ranges >> 64, []).append(e)
        for part, own in parts.items():
            yield pa.record_batch([pa.array([part], type=pa.int64()), pa.array([front_coded(own)], type=pa.binary())], names=["part", "block"])
        if spans:
            some = -1 - hash(spans[0]) % ranges
            yield pa.record_batch([pa.array([some], type=pa.int64()), pa.array([dumped(united(spans))], type=pa.binary())], names=["part", "block"])

    return joined.select(F.struct("key", "row", "spots").alias("head"), "packed").mapInArrow(scan, "part long, block binary")


def dumped(rows: list) -> bytes:
    """Rows of integers (and perhaps byte strings) as one compressed block, column by column."""
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps([np.array(c, dtype=np.int64) if isinstance(c[0], int) else c for c in zip(*rows, strict=True)]))


def loaded(block: bytes) -> list[tuple]:
    return list(zip(*(c.tolist() if isinstance(c, np.ndarray) else c for c in pickle.loads(zstandard.ZstdDecompressor().decompress(block))), strict=True))


def whole_span(e: tuple[bytes, int, int, int, int]) -> tuple[int, int, int, int]:
    """(key, row, start, end) of all windows of an entry."""
    return e[2], e[3], e[4] - (len(e[0]) - 8 - e[1]), e[4] + e[1]


def repeated_windows(group: list[tuple[int, tuple]], length: int) -> list[tuple[int, int, int, int]]:
    """Spans of all but the first place of each window; group: (longest prefix shared with a neighbour, entry)."""
    first: dict[bytes, tuple[int, int, int]] = {}
    own: list[tuple[tuple[int, int, int], bytes]] = []
    for near, e in group:
        behind = len(e[0]) - 8 - e[1]
        segment = e[0][:7 + e[1]:-1] + e[0][8:8 + e[1]]
        for i in range(len(segment) - length + 1):
            if i + length - behind > near - 8:
                break
            w, at = segment[i:i + length], (e[2], e[3], e[4] - behind + i)
            own.append((at, w))
            if (old := first.get(w)) is None or at < old:
                first[w] = at
    return [(at[0], at[1], at[2], at[2] + length) for at, w in own if first[w] < at]


def repeated_in_large(entries: list[tuple], length: int) -> list[tuple[int, int, int, int]]:
    """``repeated_windows`` of many suffixes of one anchor string: by sorting the windows at each place of the anchor."""
    entries = sorted(entries, key=lambda e: e[2:])  # then the first of equal windows is the earliest
    ahead = np.zeros((len(entries), length + KMER + 256), dtype=np.uint8)
    behind = np.zeros((len(entries), 128), dtype=np.uint8)  # backwards
    n_ahead, n_behind = np.array([e[1] for e in entries]), np.array([len(e[0]) - 8 - e[1] for e in entries])
    for i, e in enumerate(entries):
        ahead[i, :e[1]] = np.frombuffer(e[0], dtype=np.uint8, count=e[1], offset=8)
        behind[i, :n_behind[i]] = np.frombuffer(e[0], dtype=np.uint8, offset=8 + e[1])
    spans = []
    for back in range(int(n_behind.max()) + 1):
        has = np.flatnonzero((n_behind >= back) & (n_ahead >= length - back))
        if len(has) < 2:
            continue
        w = np.ascontiguousarray(np.concatenate([behind[has, :back], ahead[has, :length - back]], axis=1)).view(f"V{length}").ravel()
        _, first, inverse = np.unique(w, return_index=True, return_inverse=True)
        for i in has[np.flatnonzero(first[inverse] != np.arange(len(has)))].tolist():
            e = entries[i]
            spans.append((e[2], e[3], e[4] - back, e[4] - back + length))
    return spans


def united(spans: Iterable[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Spans of each document, joined where they touch or overlap."""
    out: list[list[int]] = []
    for k, r, a, b in sorted(spans):
        if out and out[-1][0] == k and out[-1][1] == r and a <= out[-1][3]:
            out[-1][3] = max(out[-1][3], b)
        else:
            out.append([k, r, a, b])
    return [tuple(x) for x in out]


def repeated_spans(runs: DataFrame, length: int, group_limit: int, small_group: int) -> DataFrame:
    """(kind, block): blocks of spans to remove (kind 0), and of windows of very large groups (kind 1)."""
    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        spans: list[tuple[int, int, int, int]] = []
        out: list[tuple[int, bytes]] = []
        if frame["part"].iloc[0] < 0:
            out += [(0, block) for block in frame["block"]]
        else:
            group: list[list] = []  # [longest prefix shared with a neighbour, entry] of one anchor string
            seen = 0

            def closed() -> None:
                nonlocal group, seen, spans
                if seen > group_limit:
                    spill(group)
                elif len(group) > small_group:
                    spans += repeated_in_large([g[1] for g in group], length)
                elif len(group) > 1:
                    spans += repeated_windows(group, length)
                group, seen = [], 0
                if len(spans) > 100_000:
                    out.append((0, dumped(united(spans))))
                    spans = []

            def spill(some: list) -> None:
                rows = []
                for _, e in some:
                    behind = len(e[0]) - 8 - e[1]
                    segment = e[0][:7 + e[1]:-1] + e[0][8:8 + e[1]]
                    rows += [(e[2], e[3], e[4] - behind + i, segment[i:i + length]) for i in range(len(segment) - length + 1)]
                out.append((1, dumped(rows)))

            for shared, r in merged([Run(b) for b in frame["block"]]):
                e = (r.suffix, r.ahead[r.i], r.keys[r.i], r.rows[r.i], r.places[r.i])
                if shared < 8 + KMER:
                    closed()
                if group and e[0] == group[-1][1][0] and e[1] == group[-1][1][1]:
                    old = group[-1][1]
                    if e[2:] == old[2:]:
                        continue
                    later, earlier = (e, old) if e[2:] > old[2:] else (old, e)
                    spans.append(whole_span(later))
                    group[-1][1] = earlier
                    continue
                if group:
                    group[-1][0] = max(group[-1][0], shared)
                group.append([shared if group else 0, e])
                seen += 1
                if seen > group_limit and len(group) > min(group_limit, 1000):  # all but the last, whose equals may still come
                    spill(group[:-1])
                    group = group[-1:]
            closed()
        if spans:
            out.append((0, dumped(united(spans))))
        return pd.DataFrame(out, columns=["kind", "block"])

    return runs.groupBy("part").applyInPandas(combine, "kind int, block binary")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, group_limit: int = GROUP,
                   small_group: int = SMALL_GROUP) -> DataFrame:
    """One row for each row of ``df``: id, n_bytes, n_removed, n_spans, kept (the remaining bytes), removed (spans).

    A byte is removed if a string of ``length`` bytes that covers it also starts earlier: in a document with a smaller id,
    or in the same document at an earlier byte. Strings do not cross documents and are judged on the input. NULL texts
    are empty. Ids may be of any type that has an order; a NULL id comes before all others. Different texts with one id are different documents, in
    the order of a hash of the text (told apart by 64 bits of hash and the length); a repeated row (same id, same text) is the same document and
    gets the same result. An empty table gives an empty result. Other columns of ``df`` are not read.
    """
    if not KMER <= length <= KMER + 127:
        raise ValueError(f"length must be from {KMER} to {KMER + 127}")
    docs, numbered = documents_of(df, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = repeated_anchors(anchor_rows(docs.where(F.octet_length("text") >= length), length, numbered))
    spots = found.groupBy("key", "row").agg(F.collect_list("spot").alias("spots"))
    texts = packed_texts(docs)
    held = texts.select("key", "row", "packed").join(spots, ["key", "row"])
    results = written(repeated_spans(suffix_runs(held, length, max(8, size // RANGE_BYTES)), length, group_limit, small_group))

    def exploded(kind: int, schema: str) -> DataFrame:
        def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in batch.column(0).to_pylist():
                    rows = loaded(block)
                    yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names=[n.split()[0] for n in schema.split(", ")])

        return results.where(F.col("kind") == kind).select("block").mapInArrow(scan, schema)

    windows = exploded(1, "key long, row long, start long, window binary")
    firsts = windows.groupBy("window").agg(F.min(F.struct("key", "row", "start")).alias("first"))
    later = windows.join(firsts, "window").where(F.struct("key", "row", "start") > F.col("first")).select("key", "row", "start", (F.col("start") + length).alias("end"))
    every = exploded(0, "key long, row long, start long, end long").union(later)
    spans = every.groupBy("key", "row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    arrow_id = to_arrow_type(docs.schema["id"].dataType)
    judged = texts.join(spans, ["key", "row"], "left").select(F.struct("id", "spans").alias("head"), "packed")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for heads, bodies in unpacked(batches):
            out: dict[str, list] = {"id": [], "n": [], "gone": [], "kept": [], "spans": []}
            for head, text in zip(heads, bodies, strict=True):
                gone = [(a, b) for _, _, a, b in united((0, 0, s["start"], s["end"]) for s in head["spans"] or ())]
                at, kept = 0, []
                for a, b in gone:
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                out["id"].append(head["id"])
                out["n"].append(len(text))
                out["gone"].append(sum(b - a for a, b in gone))
                out["kept"].append(b"".join(kept))
                out["spans"].append([{"start": a, "end": b} for a, b in gone])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch(
                [pa.array(out["id"], type=arrow_id), pa.array(out["n"], type=pa.int64()), pa.array(out["gone"], type=pa.int64()),
                 pa.array([len(s) for s in out["spans"]], type=pa.int64()), pa.array(out["kept"], type=pa.binary()), pa.array(out["spans"], type=span)],
                names=[id_col, "n_bytes", "n_removed", "n_spans", "kept", "removed"])

    return judged.mapInArrow(cut, f"`{id_col}` {docs.schema['id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary, removed array<struct<start:long,end:long>>")
