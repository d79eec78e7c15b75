"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

**Terms.** Words (runs of ASCII letters, lower-cased, digits and characters beyond ASCII) and their beginnings of five
characters, which catch inflected forms. The vocabulary is every term of every example; none is left out. Inverse
document frequencies are counted over **all** documents. A term that tells the labels apart (by chi-squared of presence
and label) may weigh more than its frequencies alone say: by how much, if at all, is chosen among ``STRENGTHS`` by
cross-validation on the examples, where the chi-squared of each fold comes from the other folds. 0 is plain TF-IDF.

**Index.** The examples (a bounded sample of the labelled rows: ``examples_per_label`` of each label, chosen by a hash
of the id, and of these the texts of at most ``example_bytes``) are TF-IDF vectors of length one. Each term has a list of (example, weight), cut
into blocks of examples, and the largest weight of each block. Examples that are near each other stand together, so that blocks differ. The
terms that many examples hold are rows of a matrix instead, whose product with the queries is cheaper than their lists. A query adds the block
maxima of its other terms to an upper bound for every block, reads the blocks of the highest bounds and then those whose
bound reaches the ``k``-th best cosine so far: what it returns are exactly the ``k`` nearest examples. Queries go through these steps in batches.

**Score.** The examples vote with the square of their cosine; votes are corrected for the share of each label in the
sample, so that the score estimates a probability at the labels' true rate. A text without any vocabulary term gets
the rate of such examples. The nearest examples are the evidence.

The terms of the examples and of all documents are counted in tasks; the driver holds the sparse vectors of the examples, bounded by the two
parameters, and one number for each term.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .batches import ALNUM, parts, slices, with_columns

BLOCK = 32
PREFIXES = (5,)
#: A term's weight grows by this times the square root of its chi-squared; 0 is plain TF-IDF.
STRENGTHS = (0.0, 0.1, 0.2, 0.4, 0.8)
FOLDS = 5
#: Blocks read first; a term that more than one of ``OFTEN`` examples holds is a row of the matrix.
FIRST_BLOCKS, OFTEN = 8, 32
#: Words of which a task remembers the terms; texts counted and searched at once.
WORDS, COUNTED, TOGETHER = 400_000, 64, 256
#: Weight of the rate of termless examples among the votes.
FAR = 0.02
#: Terms whose counts travel in one row.
TERM_RANGE = 4096


def words_of(text: bytes | str | None) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return raw.translate(ALNUM).split()


def terms_of(word: bytes) -> list[bytes]:
    """The word and its marked beginnings."""
    return [word, *(b"^" + word[:n] for n in PREFIXES if len(word) >= n)]


class Vocabulary(dict):
    """Word to a number; for each number the places of the word's terms among the known terms (all of its own if none are given)."""

    def __init__(self, place: dict[bytes, int] | None = None) -> None:
        self.grows = place is None
        self.place = {} if place is None else place
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[list[int]] = [[]]
        self.numbers = 0
        self.places, self.first = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def __missing__(self, word: bytes) -> int:
        place = self.place
        if self.grows:
            got = [place.setdefault(t, len(place)) for t in terms_of(word)]
        else:
            got = [place[word]] if word in place else []
            for n in PREFIXES:
                if len(word) >= n and (t := b"^" + word[:n]) in place:
                    got.append(place[t])
        if got:
            self.new.append(got)
            self.numbers += 1
        self[word] = number = self.numbers if got else 0  # words without a known term share a number
        return number

    def counts(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place, occurrences) of all known terms of the texts, in the order of the texts."""
        found = [self._counted(texts[a:a + COUNTED]) for a in range(0, len(texts), COUNTED)]
        return tuple(np.concatenate([x + a * COUNTED if i == 0 else x for a, x in enumerate(c)]) for i, c in enumerate(zip(*found, strict=True))) if found else (np.zeros(0, dtype=np.int64),) * 3

    def _counted(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self) > WORDS:
            self.forget()
        words = [[self[w] for w in words_of(t)] for t in texts]
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.fromiter(chain.from_iterable(words), dtype=np.int64, count=int(size.sum()))
        if self.new:
            width = np.fromiter(map(len, self.new), dtype=np.int64, count=len(self.new))
            self.places = np.concatenate([self.places, np.fromiter(chain.from_iterable(self.new), dtype=np.int64, count=int(width.sum()))])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(width)])
            self.new = []
        base = self.numbers + 1
        keys, n = tallied(np.repeat(np.arange(len(words)), size) * base + flat)
        lo, hi = self.first[keys % base], self.first[keys % base + 1]
        at = self.places[ranges(lo, hi)]
        keys = np.repeat(keys // base, hi - lo) * max(1, len(self.place)) + at
        n = np.repeat(n, hi - lo)
        base = max(1, len(self.place))
        keys, n = tallied(keys, n)
        return keys // base, keys % base, n


def tallied(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in the order in which they first come, and how often each comes (or the sum of its ``n``)."""
    coded = pa.array(keys).dictionary_encode()
    held = coded.dictionary.to_numpy()
    return held, np.bincount(coded.indices.to_numpy(), n, minlength=len(held)).astype(np.int64)


def ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """lo[0]..hi[0]-1, lo[1]..hi[1]-1, ... in one array."""
    n = hi - lo
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


class Examples:
    """Sparse term counts of the labelled examples: entries (example, term, n) sorted by both. They travel compressed."""

    def __init__(self, ids: list, labels: np.ndarray, example: np.ndarray, term: np.ndarray, n: np.ndarray, terms: int, share: tuple[float, float]) -> None:
        self.ids, self.labels, self.example, self.term, self.n, self.terms, self.share = ids, labels, example, term, n, terms, share

    def __getstate__(self) -> bytes:
        columns = [np.diff(c, prepend=0).astype(np.int32) for c in (self.example, self.term, self.n)]
        return zstandard.ZstdCompressor(level=6).compress(pickle.dumps((self.ids, self.labels, columns, self.terms, self.share)))

    def __setstate__(self, state: bytes) -> None:
        self.ids, self.labels, columns, self.terms, self.share = pickle.loads(zstandard.ZstdDecompressor().decompress(state))
        self.example, self.term, self.n = (np.cumsum(c, dtype=np.int64) for c in columns)

    def subset(self, keep: np.ndarray) -> Examples:
        number = np.cumsum(keep) - 1
        own = keep[self.example]
        return Examples([i for i, k in zip(self.ids, keep.tolist(), strict=True) if k], self.labels[keep], number[self.example[own]], self.term[own], self.n[own],
                        self.terms, self.share)

    def chi(self) -> np.ndarray:
        """Square root of the chi-squared of each term's presence and the label (0 for a term in no or every example)."""
        toxic = self.labels[self.example] > 0
        a = np.bincount(self.term[toxic], minlength=self.terms).astype(np.float64)
        b = np.bincount(self.term[~toxic], minlength=self.terms).astype(np.float64)
        n1 = float((self.labels > 0).sum())
        n0 = float(len(self.labels) - n1)
        below = (a + b) * (n1 - a + n0 - b) * n1 * n0
        return np.sqrt((a * (n0 - b) - b * (n1 - a)) ** 2 * (n1 + n0) / np.where(below > 0, below, np.inf))


def weighed(row: np.ndarray, at: np.ndarray, n: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """(1 + log n) * weight of each entry, over the length of its row's vector."""
    w = (1.0 + np.log(n)) * weight[at]
    norm = np.sqrt(np.bincount(row, w * w, minlength=rows))
    return w / np.where(norm > 0, norm, 1.0)[row]


def neighbours_together(example: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """An order of the examples: split in two again and again by nearness to two of them that are far apart."""
    first = np.searchsorted(example, np.arange(n + 1))
    scratch = np.zeros(int(term.max()) + 1 if len(term) else 1)

    def cosines(to: int, members: np.ndarray) -> np.ndarray:
        own = slice(first[to], first[to + 1])
        scratch[term[own]] = weight[own]
        lo, hi = first[members], first[members + 1]
        entries = ranges(lo, hi)
        out = np.bincount(np.repeat(np.arange(len(members)), hi - lo), scratch[term[entries]] * weight[entries], minlength=len(members))
        scratch[term[own]] = 0.0
        return out

    out, waiting = [], [np.arange(n)]
    while waiting:
        members = waiting.pop()
        if len(members) <= BLOCK:
            out.append(members)
            continue
        a = int(members[cosines(int(members[0]), members).argmin()])
        near_a = cosines(a, members)
        nearness = near_a - cosines(int(members[near_a.argmin()]), members)
        order = members[np.argsort(-nearness, kind="stable")]
        half = -(-len(order) // (2 * BLOCK)) * BLOCK  # whole blocks
        waiting += [order[half:], order[:half]]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


class Index:
    """Block-max inverted index over the examples' vectors; ``weight`` is the factor of each term."""

    def __init__(self, of: Examples, weight: np.ndarray) -> None:
        self.weight_of = weight
        n, share, labels = len(of.ids), of.share, of.labels
        w = weighed(of.example, of.term, of.n, weight, n)
        held = np.bincount(of.example, minlength=n) > 0
        some = neighbours_together(of.example, of.term, w, n)
        some = some[held[some]]
        number = np.full(n, -1)
        number[some] = np.arange(len(some))
        self.ids = [of.ids[i] for i in some.tolist()]
        self.labels = labels[some].astype(np.float64)
        self.vote = np.where(self.labels > 0, share[1], share[0])
        everyone = np.where(labels > 0, share[1], share[0])
        rate = float((everyone * labels).sum() / everyone.sum()) if n else 0.0
        # one example at the overall rate keeps the rate of few termless examples from being extreme
        self.empty_rate = float(((everyone * labels)[~held].sum() + rate) / (everyone[~held].sum() + 1.0)) if not held.all() else rate
        self.n_blocks = -(-len(some) // BLOCK)
        example, term = number[of.example], of.term
        often = np.flatnonzero(np.bincount(term, minlength=of.terms) * OFTEN > len(some))
        self.row = np.full(of.terms, -1)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), self.n_blocks * BLOCK), dtype=np.float32)
        common = self.row[term] >= 0
        self.dense[self.row[term[common]], example[common]] = w[common]
        # the lists of the other terms, and for each term and block of examples the first entry and the largest weight
        term, example, w = term[~common], example[~common], w[~common]
        order = np.lexsort((example, term))
        term, self.example, self.weight = term[order], example[order].astype(np.int32), w[order].astype(np.float32)
        cell = term * max(1, self.n_blocks) + self.example // BLOCK
        start = np.flatnonzero(np.diff(cell, prepend=-1))
        self.block = self.example[start] // BLOCK
        self.most = np.maximum.reduceat(self.weight, start) if len(start) else np.zeros(0, dtype=np.float32)
        self.start = np.append(start, len(term))
        self.first = np.searchsorted(term[start], np.arange(of.terms + 1))

    def nearest(self, text: np.ndarray, at: np.ndarray, w: np.ndarray, texts: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of examples found, examples, cosines) of each text: the ``k`` largest cosines above 0, exactly, ties to the earlier
        example, largest first. Entries (text, place, weight) are sorted by text."""
        size = self.n_blocks * BLOCK
        if not size:
            return np.zeros(texts, dtype=np.int64), np.zeros((texts, 0), dtype=np.int64), np.zeros((texts, 0))
        row = self.row[at]
        common = row >= 0
        query = np.zeros((texts, len(self.dense)), dtype=np.float32)
        query[text[common], row[common]] = w[common]
        scores = (query @ self.dense).astype(np.float64)
        text, at, w = text[~common], at[~common], w[~common]
        lo, hi = self.first[at], self.first[at + 1]
        cells = ranges(lo, hi)
        owner, w = np.repeat(text, hi - lo), np.repeat(w, hi - lo)
        place = owner * self.n_blocks + self.block[cells]
        bounds = scores.reshape(texts, self.n_blocks, BLOCK).max(axis=2) + np.bincount(place, w * self.most[cells], minlength=texts * self.n_blocks).reshape(texts, -1)
        first = min(FIRST_BLOCKS, self.n_blocks)
        wanted = np.zeros((texts, self.n_blocks), dtype=bool)
        wanted[np.arange(texts)[:, None], np.argpartition(-bounds, first - 1, axis=1)[:, :first]] = True
        read = np.zeros_like(wanted)
        while wanted.any():
            here = wanted.reshape(-1)[place]
            lo, hi = self.start[cells[here]], self.start[cells[here] + 1]
            entries = ranges(lo, hi)
            scores += np.bincount(np.repeat(owner[here], hi - lo) * size + self.example[entries], np.repeat(w[here], hi - lo) * self.weight[entries],
                                  minlength=texts * size).reshape(texts, size)
            read |= wanted
            known = np.where(np.repeat(read, BLOCK, axis=1), scores, -1.0)
            least = np.partition(known, -k, axis=1)[:, -k] if size >= k else np.full(texts, -1.0)
            wanted = ~read & (bounds > 0) & (bounds >= least[:, None] - 1e-6)
        k = min(k, size)
        known[known <= 0] = -1.0
        # the k-th best and all that tie with it, then the earliest of those
        best = np.argsort(-known, axis=1, kind="stable")[:, :k] if size <= 4 * BLOCK else self._best(known, k)
        cosines = np.take_along_axis(known, best, axis=1)
        return (cosines > 0).sum(axis=1), best, cosines

    @staticmethod
    def _best(known: np.ndarray, k: int) -> np.ndarray:
        least = np.partition(known, -k, axis=1)[:, -k]
        out = np.empty((len(known), k), dtype=np.int64)
        for i, bar in enumerate(least.tolist()):
            found = np.flatnonzero(known[i] >= bar)
            out[i] = found[np.argsort(-known[i][found], kind="stable")[:k]]
        return out

    def scores(self, text: np.ndarray, at: np.ndarray, n: np.ndarray, texts: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(score, neighbours, examples, cosines) of each text, from its term counts."""
        score = np.full(texts, self.empty_rate)
        sizes, best, cosines = [np.zeros(0, dtype=np.int64)], [np.zeros((0, min(k, self.n_blocks * BLOCK)), dtype=np.int64)], [np.zeros((0, min(k, self.n_blocks * BLOCK)))]
        w = weighed(text, at, n, self.weight_of, texts)
        for a in range(0, texts, TOGETHER):
            b = min(texts, a + TOGETHER)
            lo, hi = np.searchsorted(text, [a, b])
            size, near, cos = self.nearest(text[lo:hi] - a, at[lo:hi], w[lo:hi], b - a, k)
            if near.shape[1]:
                # distance-weighted votes, with a little of the rate of termless texts for far neighbours
                vote = np.where(cos > 0, cos * cos, 0.0) * self.vote[np.minimum(near, len(self.vote) - 1)]
                found = ((vote * self.labels[np.minimum(near, len(self.labels) - 1)]).sum(axis=1) + FAR * self.empty_rate) / (vote.sum(axis=1) + FAR)
                score[a:b] = np.where(size > 0, np.clip(found, 0.0, 1.0), self.empty_rate)
            sizes.append(size)
            best.append(near)
            cosines.append(cos)
        return score, np.concatenate(sizes), np.concatenate(best), np.concatenate(cosines)


def examples(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, learn: Column, per_label: int, most_bytes: int) -> tuple[Examples, list[bytes]]:
    """The bounded sample and its vocabulary; ``learn`` is a condition on ``label_id``."""
    marked = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1)).where(learn)
    sizes = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = None
    for y in (0, 1):  # ids alone are ranked, then joined with the texts
        own = marked.where(F.col("y") == y).orderBy(F.xxhash64("label_id"), "label_id").limit(per_label)
        picked = own if picked is None else picked.union(own)
    picked = F.broadcast(picked.dropDuplicates(["label_id"]))  # 2 * per_label ids at most
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    got = df.select(F.col(id_col).alias("id"), text.alias("text")).where(F.octet_length("text") <= most_bytes).join(picked, F.col("id") == F.col("label_id"))
    # rows of one id: the smallest text stands for it, whatever the order of rows
    got = got.groupBy("id").agg(F.min("text").alias("text"), F.min("y").alias("y"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            known = Vocabulary()
            text, at, n = known.counts(part.column(1).cast(pa.binary()).to_pylist())
            names = pa.array(list(known.place), pa.binary()).take(pa.array(at))
            offsets = pa.array(np.searchsorted(text, np.arange(len(part) + 1)), pa.int32())
            yield pa.record_batch([part.column(0), part.column(2), pa.ListArray.from_arrays(offsets, names), pa.ListArray.from_arrays(offsets, pa.array(n))], names=["id", "y", "terms", "n"])

    kind = df.schema[id_col].dataType.simpleString()
    table = got.mapInArrow(scan, f"id {kind}, y int, terms array<binary>, n array<long>").toArrow().combine_chunks()
    ids = table.column("id").to_pylist()
    order = np.array(sorted(range(len(ids)), key=lambda i: str(ids[i])), dtype=np.int64)
    table = table.take(pa.array(order))
    lists = table.column("terms").combine_chunks()
    flat = lists.flatten().cast(pa.binary())
    terms = sorted(pc.unique(flat).to_pylist())
    at = pc.index_in(flat, pa.array(terms, pa.binary())).to_numpy(zero_copy_only=False).astype(np.int64)
    example = np.repeat(np.arange(len(ids)), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)) if len(ids) else np.zeros(0, dtype=np.int64)
    n = table.column("n").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    by = np.lexsort((at, example))
    y = table.column("y").to_numpy().astype(np.int64)
    share = (sizes.get(0, 0) / max(1, int((y == 0).sum())), sizes.get(1, 0) / max(1, int((y == 1).sum())))
    return Examples([ids[i] for i in order.tolist()], y, example[by], at[by], n[by], len(terms), share), terms


def document_frequencies(df: DataFrame, text_col: str, terms: list[bytes], names: Broadcast) -> tuple[np.ndarray, int]:
    """In how many of all documents each term stands, and the number of documents; ``names`` is the broadcast of ``terms``.

    A task adds its counts up and gives a row for each range of terms, at most four tasks for each slot of the cluster; the rows of a range are
    added in one task, which reads as many rows as there were tasks.
    """
    spark, n_terms = df.sparkSession, len(terms)
    ranges_ = -(-(len(terms) + 1) // TERM_RANGE)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(dict(zip(names.value, range(n_terms), strict=True)))
        seen = np.zeros(ranges_ * TERM_RANGE, dtype=np.int64)
        for _, texts in slices(batches):
            seen[n_terms] += len(texts)
            _, at, _ = known.counts(texts)
            seen += np.bincount(at, minlength=len(seen))
        for r in range(ranges_):
            part = seen[r * TERM_RANGE:(r + 1) * TERM_RANGE]
            if part.any():
                yield pa.record_batch([pa.array([r], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["r", "n"])

    def add(key: tuple[pa.Scalar, ...], groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TERM_RANGE, dtype=np.int64)
        for batch in groups:
            for b in batch.column("n").to_pylist():
                total += np.frombuffer(b, dtype=np.int64)
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["r", "n"])

    rows = df.select(F.lit(0).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.coalesce(4 * spark.sparkContext.defaultParallelism)
    out = np.zeros(ranges_ * TERM_RANGE, dtype=np.int64)
    for r in rows.mapInArrow(scan, "r int, n binary").groupBy("r").applyInArrow(add, "r int, n binary").collect():  # a number for each term
        out[r["r"] * TERM_RANGE:(r["r"] + 1) * TERM_RANGE] = np.frombuffer(r["n"], dtype=np.int64)
    return out[:len(terms)], int(out[len(terms)])


def fold_loss(of: Examples, idf: np.ndarray, strength: float, fold: int, k: int) -> tuple[float, float]:
    """(weighted squared error, weight) of the scores of one fold's examples, learnt from the other folds."""
    mine = np.arange(len(of.ids)) % FOLDS == fold
    others, own = of.subset(~mine), of.subset(mine)
    index = Index(others, idf * (1.0 + strength * others.chi()))
    score = index.scores(own.example, own.term, own.n, len(own.ids), k)[0]
    weight = np.where(own.labels > 0, of.share[1], of.share[0])
    return float((weight * (score - own.labels) ** 2).sum()), float(weight.sum())


def best_strength(df: DataFrame, of: Examples, shared: Broadcast, k: int) -> float:
    """The factor among ``STRENGTHS`` with the least squared error (Brier score) in cross-validation; folds are scored in tasks. ``shared`` is
    the broadcast of the examples and the terms' inverse document frequencies."""
    if len(of.ids) < 2 * FOLDS or not of.labels.any() or of.labels.all():
        return 0.0
    spark = df.sparkSession

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                loss, weight = fold_loss(*shared.value, STRENGTHS[i // FOLDS], i % FOLDS, k)
                yield pa.record_batch([pa.array([i // FOLDS], pa.int32()), pa.array([loss]), pa.array([weight])], names=["s", "loss", "weight"])

    work = spark.range(0, len(STRENGTHS) * FOLDS, 1, len(STRENGTHS) * FOLDS).mapInArrow(scan, "s int, loss double, weight double")
    found = {r["s"]: r["loss"] for r in work.groupBy("s").agg((F.sum("loss") / F.sum("weight")).alias("loss")).collect()}
    return STRENGTHS[min(found, key=lambda s: (round(found[s], 9), s))]


def learnt(of: Examples, idf: np.ndarray, strength: float) -> Index:
    """The index of all examples; a worker builds it once for all its tasks."""
    if getattr(of, "index", None) is None:
        of.index = Index(of, idf * (1.0 + strength * of.chi()))
    return of.index


def score_toxicity(df: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                   examples_per_label: int = 800, example_bytes: int = 200_000, k: int = 15, threshold: float = 0.3, carry: bool = False) -> DataFrame:
    """One row for each row of ``df``: id, score, predicted, evidence (nearest examples' ids), evidence_cosine.

    ``learn`` is a condition on the column ``label_id``: which labels may be learnt from. Only texts are looked at when
    scoring. NULL and empty texts, and texts without a term of any example, get the rate of such examples. Labels other than
    0 and 1, labels without a document and repeated labels of an id beyond one are left out; of several texts of a labelled id the smallest counts; without any
    label every score is 0. An example never counts as its own evidence only in that its row is scored like any other: a learnt text
    finds itself. Ids may be NULL or repeat; an empty table gives an empty result. With ``carry``, the input row comes
    as the struct ``row`` in place of the id. Other columns of ``df`` are not looked at.
    """
    of, terms = examples(df, labels, id_col, text_col, label_col, learn, examples_per_label, example_bytes)
    context = df.sparkSession.sparkContext
    names = context.broadcast(terms)
    found, n_docs = document_frequencies(df, text_col, terms, names)
    shared = context.broadcast((of, (np.log((1.0 + n_docs) / (1.0 + found)) + 1.0).astype(np.float32)))
    strength = best_strength(df, of, shared, k)
    id_type, arrow_id = df.schema[id_col].dataType.simpleString(), to_arrow_type(df.schema[id_col].dataType)

    def make():
        own = learnt(*shared.value, strength)
        known = Vocabulary({t: i for i, t in enumerate(names.value)})
        ids = pa.array(own.ids, arrow_id)

        def compute(texts: list) -> list[pa.Array]:
            score, size, best, cosines = own.scores(*known.counts(texts), len(texts), k)
            offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
            held = np.arange(best.shape[1]) < size[:, None]
            return [pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.ListArray.from_arrays(offsets, ids.take(pa.array(best[held]))),
                    pa.ListArray.from_arrays(offsets, pa.array(cosines[held]))]
        return compute

    return with_columns(df, id_col, text_col, f"score double, predicted int, evidence array<{id_type}>, evidence_cosine array<double>",
                        ["score", "predicted", "evidence", "evidence_cosine"], make, carry)
