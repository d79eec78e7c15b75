"""Best-fit packing: a configuration linear program over the length histogram, by multiplicative weights.

Documents become token pieces of at most ``capacity`` tokens; the pieces go into as few sequences as possible.

**Program.** A configuration is a multiset of lengths that fits a sequence. The program asks for the fewest
sequences (a number of copies for each configuration) that hold every length as often as the histogram has it. It
sees the histogram alone: at most ``capacity`` numbers, whatever the size of the corpus.

**Solution.** Multiplicative weights keep a price for each length, lower the more it is covered. In each step an
unbounded knapsack by dynamic programming over the capacity prices the configurations: one table gives, for every
length at once, the best configuration that contains it. Near-best ones get more copies, and the prices follow in smaller and smaller steps.
Prices, and running means of them, are a dual solution: the worth of all pieces over that of the dearest configuration is a **lower bound** of
the sequences that any packing needs.

**Rounding.** Whole copies are placed by the best prices, a small share of the counts at a time: near-best configurations, full or
not, with prices tilted so that lengths that lag behind come first. What no whole configuration takes any more goes best-fit decreasing. The prices are
refined and the rounding repeated until it is within ``GAP`` of the bound, or ``STEPS`` steps are done; the packing with the fewest sequences (plain
best-fit decreasing among them) counts.

**Placement.** Pieces are ranked within their length (in parallel, in hash buckets whose number grows with the
input, so a hot length is not one task), and the k-th piece of a length takes its k-th slot.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .batches import slices, text_rows, written

#: Steps of multiplicative weights before each rounding, first rate, and how near to the best price a configuration must be.
STEPS, RATE, NEAR = (100, 400, 1000), 0.2, 0.005
#: Share of the bound by which the sequences may exceed it before more steps are worth their while.
GAP = 0.001
#: Tilts of the prices by progress, share of the counts placed at once, and nearness in rounding.
TILTS, SHARE, NEAR_PLACED = (3.0, 10.0), 0.02, 0.001
#: Pieces in a ranking bucket, on average.
RANK_ROWS = 200_000


def default_ranks() -> str:
    """Path of the rank file that holds the vocabulary of byte_bpe_50k.json."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_json() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """ids of whole texts in the vocabulary of byte_bpe_50k.json, special strings as ordinary text.

    The same vocabulary is read as ranks, which encodes several times faster to the same ids (the tests compare them); a
    text on which that library gives up (an endless white-space run) goes to the other one.
    """

    def __init__(self, ranks: str | None = None, json: str | None = None) -> None:
        import public_tokenizers
        import tiktoken
        with open(ranks or default_ranks(), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.sizes = np.zeros(max(table.values()) + 1, dtype=np.int64)  # bytes of each token
        self.sizes[list(table.values())] = [len(t) for t in table]
        self.json, self.slow = json, None

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.uint32)
        try:
            return np.array(self.encoding._core_bpe.encode_ordinary(text), dtype=np.uint32)
        except BaseException as e:  # the library's panics are no Exceptions
            if isinstance(e, (KeyboardInterrupt, SystemExit, GeneratorExit, MemoryError)):
                raise
            if self.slow is None:
                from tokenizers import Tokenizer
                self.slow = Tokenizer.from_file(self.json or default_json())
                self.slow.encode_special_tokens = True
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


_encoders: dict[str | None, Encoder] = {}


def encoder(ranks: str | None = None) -> Encoder:
    """The worker's encoder for a rank file: built once, since each one built anew keeps its memory."""
    if ranks not in _encoders:
        _encoders[ranks] = Encoder(ranks)
    return _encoders[ranks]


def token_pieces(df: DataFrame, id_col: str, text_col: str, capacity: int, end_id: int, ranks: str | None) -> DataFrame:
    """(id, piece, start, length, ids_crc32): pieces of ``capacity`` tokens, of which the first may be shorter."""
    rows = text_rows(df, id_col, text_col)
    kind = to_arrow_type(rows.schema["id"].dataType)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks)
        for ids, texts in slices(batches, as_text=True):
            out: list[tuple] = []
            for i, t in zip(ids, texts, strict=True):
                tokens = np.append(encode(t), np.uint32(end_id)).astype("<u4")
                cuts = [0, *range((len(tokens) - 1) % capacity + 1, len(tokens) + 1, capacity)]
                raw = tokens.tobytes()
                out += [(i, k, a, b - a, zlib.crc32(raw[4 * a:4 * b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
            cols = list(zip(*out, strict=True))
            yield pa.record_batch([pa.array(c, type=t) for c, t in zip(cols, (kind, pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def knapsack(price: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """best[c]: the most price that fits in c; item[c]: a length that ends such a filling (0: a token stays empty)."""
    size = len(price)  # price[l] for lengths 0 .. capacity; price[0] = 0 stands for an empty token
    best, item = np.zeros(size), np.zeros(size, dtype=np.int64)
    for c in range(1, size):
        total = best[c - 1::-1] + price[1:c + 1] if c > 1 else best[:1] + price[1:2]
        at = int(total.argmax())
        if total[at] > best[c - 1]:
            best[c], item[c] = total[at], at + 1
        else:
            best[c] = best[c - 1]
    return best, item


def filling(item: np.ndarray, space: int) -> list[int]:
    out = []
    while space > 0:
        if item[space]:
            out.append(int(item[space]))
            space -= int(item[space])
        else:
            space -= 1
    return out


class Prices:
    """Prices of the lengths by multiplicative weights, refined step by step; ``bound`` and ``best`` are those of the best dual solution so far,
    scaled so that no configuration is worth more than 1."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts, self.capacity = counts, len(counts) - 1
        self.there = np.flatnonzero(counts)
        self.weight = np.zeros(len(counts))
        self.weight[self.there] = self.there / self.capacity
        self.mean, self.steps = np.zeros(len(counts)), 0
        self.bound, self.best = 0.0, self.weight
        self.tried(self.weight, knapsack(self.weight)[0])

    def tried(self, price: np.ndarray, worth: np.ndarray) -> None:
        bound = float((price * self.counts).sum() / worth[self.capacity])
        if bound > self.bound:
            self.bound, self.best = bound, price / worth[self.capacity]

    def refine(self, steps: int) -> None:
        there, counts, capacity = self.there, self.counts, self.capacity
        for _ in range(steps):
            worth, item = knapsack(self.weight)
            self.tried(self.weight, worth)
            new = 2.0 / (self.steps + 2)
            self.mean = self.mean * (1 - new) + self.weight / worth[capacity] * new
            total = self.weight[there] + worth[capacity - there]
            rate = RATE / np.sqrt(1 + self.steps / 8)
            added = np.zeros(len(counts))
            for length in there[total >= (1 - NEAR) * total.max()].tolist():
                kinds, n = np.unique([length, *filling(item, capacity - length)], return_counts=True)
                added[kinds] += n * float((counts[kinds] / n).min()) * rate
            self.weight[there] *= np.exp(-rate * np.minimum(added[there] / counts[there], 4.0))
            self.weight[there] /= (capacity / there * self.weight[there]).max()  # prices relative to the dearest token
            self.steps += 1
            if self.steps % 20 == 0:
                self.tried(self.mean, knapsack(self.mean)[0])


def rounded(counts: np.ndarray, price: np.ndarray, tilt: float) -> list[tuple[tuple[int, ...], int]]:
    """Whole copies of configurations that are near-best by ``price``, kept even over the lengths; the rest best-fit decreasing."""
    capacity, left = len(counts) - 1, counts.copy()
    out: dict[tuple[int, ...], int] = {}
    length = np.arange(len(counts))
    while True:
        there = np.flatnonzero(left * length >= capacity)  # no configuration has more of a length than is left
        if not len(there):
            break
        share = left[there] / counts[there]
        weight = np.zeros(len(counts))
        weight[there] = price[there] * np.exp(tilt * (share - share.mean()))
        worth, item = knapsack(weight)
        total = weight[there] + worth[capacity - there]
        placed = 0
        for config in {tuple(sorted([a, *filling(item, capacity - a)], reverse=True)) for a in there[total >= (1 - NEAR_PLACED) * total.max()].tolist()}:
            kinds, n = np.unique(config, return_counts=True)
            copies = min(int((left[kinds] // n).min()), max(1, int((counts[kinds] / n).min() * SHARE)))
            if copies > 0:
                out[config] = out.get(config, 0) + copies
                left[kinds] -= n * copies
                placed += copies
        if not placed:
            break
    return [*out.items(), *best_fit(left)]


def solve(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], float]:
    """((configuration, copies) that hold every length exactly as often as the histogram has it; lower bound of the sequences of any packing)."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    full = [((capacity,), int(counts[capacity]))] if counts[capacity] else []
    counts[capacity] = 0
    if not counts.any():
        return full, float(sum(n for _, n in full))

    def sequences(packing: list[tuple[tuple[int, ...], int]]) -> int:
        return sum(n for _, n in packing)

    best, prices, before = best_fit(counts), Prices(counts), -1.0
    for steps in STEPS:
        prices.refine(steps)
        if prices.bound <= before * (1 + GAP / 10):
            break  # more steps do not change the prices
        before = prices.bound
        near = max(np.ceil(before - 1e-6), before * (1 + GAP))
        found = rounded(counts, prices.best, TILTS[0])
        if sequences(found) > near:
            found = min([found, *(rounded(counts, prices.best, tilt) for tilt in TILTS[1:])], key=sequences)
        best = min([found, best], key=sequences)
        if sequences(best) <= near:
            break
    return full + best, prices.bound + sequences(full)


def best_fit(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing of what rounding has left: the longest pieces first, into the fullest sequences that take them.

    Equal pieces go into equal sequences many at a time, so the work depends on the lengths, not on the number of pieces.
    """
    capacity = len(counts) - 1
    spaces: list[int] = []  # free space of the open groups, sorted
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # by free space: (lengths, number of sequences)
    full: dict[tuple[int, ...], int] = {}

    def put(space: int, config: tuple[int, ...], n: int) -> None:
        if space == 0:
            full[config] = full.get(config, 0) + n
            return
        if space not in groups:
            groups[space] = []
            insort(spaces, space)
        groups[space].append((config, n))

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                space, config, there = capacity, (), left
            else:
                space = spaces[at]
                config, there = groups[space].pop()
                if not groups[space]:
                    del groups[space], spaces[at]
            each = min(left, space // length)
            n = min(there, left // each)
            if config and there > n:
                put(space, config, there - n)
            put(space - each * length, config + (length,) * each, n)
            left -= each * n
    for open_ in groups.values():
        for config, n in open_:
            full[config] = full.get(config, 0) + n
    return list(full.items())


def slot_table(solution: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, list[list[int]]]]:
    """For each length: first rank and first sequence of each run of slots, and the slots' offsets in one copy."""
    table: dict[int, tuple[list, list, list]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for config, copies in solution:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in config:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, places in offsets.items():
            ranks, firsts, where = table.setdefault(length, ([], [], []))
            ranks.append(used.get(length, 0))
            firsts.append(sequence)
            where.append(places)
            used[length] = used.get(length, 0) + copies * len(places)
        sequence += copies
    return {k: (np.array(r), np.array(f), w) for k, (r, f, w) in table.items()}


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, ranks: str | None = None) -> DataFrame:
    """One row for each piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A text's tokens are followed by ``end_id``; NULL and empty texts are that one token. Only texts of more than
    ``capacity`` tokens are cut; all their pieces but perhaps the first have ``capacity`` tokens. Offsets are gapless
    from 0 within a sequence. Every row of ``df`` is packed, repeated rows and NULL ids too. Rows whose id, piece,
    start and ids are equal may change places with each other. An empty table gives an empty result. Other columns of
    ``df`` are not read.
    """
    pieces = written(token_pieces(df, id_col, text_col, capacity, end_id, ranks))
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    shared = df.sparkSession.sparkContext.broadcast(slot_table(solve(histogram, capacity)[0]))
    buckets = max(8, sum(histogram.values()) // RANK_ROWS)
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(buckets)).cast("long"))
    sums = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sums.select(F.col("length").alias("of_length"), F.col("bucket").alias("of_bucket"),
                         (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("id", "piece", "start", "ids_crc32")
    ranked = bucketed.withColumn("nth", F.row_number().over(order)).join(
        before, (F.col("length") == F.col("of_length")) & (F.col("bucket") == F.col("of_bucket"))).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth") - 1).alias("rank"))

    def place(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence, offset = np.zeros(len(frame), dtype=np.int64), np.zeros(len(frame), dtype=np.int64)
            lengths, ranks_ = frame["length"].to_numpy(), frame["rank"].to_numpy()
            for length in np.unique(lengths):
                firsts, sequences, where = shared.value[int(length)]
                rows = np.flatnonzero(lengths == length)
                run = np.searchsorted(firsts, ranks_[rows], side="right") - 1
                for k in np.unique(run):
                    own = rows[run == k]
                    copy, nth = np.divmod(ranks_[own] - firsts[k], len(where[k]))
                    sequence[own] = sequences[k] + copy
                    offset[own] = np.array(where[k])[nth]
            yield frame.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    kind = pieces.schema["id"].dataType.simpleString()
    # a task for each bucket's worth of pieces: the rows are small, and so many tasks leave files of a useful size
    placed = ranked.coalesce(buckets).mapInPandas(place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return placed.withColumnRenamed("id", id_col) if id_col != "id" else placed
