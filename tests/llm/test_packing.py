import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinfold.llm.packing import Encoder, best_fit, knapsack, pack, solve


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def check(rows, texts, plain, capacity=1024):
    """Every piece is there once, as the plain tokenizer and the cutting rule give it; sequences are gapless."""
    want = []
    for i, text in texts:
        ids = [*plain(text), 2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, capacity)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), sum(w[3] for w in want)


def test_table_round_trip(sample, plain):
    df, rows = sample
    n, tokens = check(pack(df).collect(), [(r.doc_id, r.text) for r in rows], plain)
    assert n <= 1.02 * -(-tokens // 1024)


def test_odd_rows(make_docs, plain):
    texts = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "<|endoftext|> x"), (4, "word " * 5000), (5, " x" * 1023), (6, " x" * 1022), (7, " x" * 2047), (8, "\n" * 3000)]
    docs = make_docs(texts).withColumn("length", F.lit("x")).withColumn("rank", F.lit(1))
    check(pack(docs).collect(), texts, plain)
    assert pack(make_docs([])).count() == 0
    check(pack(make_docs(texts), capacity=7).collect(), texts, plain, 7)


def test_encoder_equals_the_tokenizer(plain):
    encode = Encoder()
    for t in ("", "it's 12'LL  \n\n x y", "été 日本語 🙂🙂", "a" * 3000, "  \t\t ", " x \u0000 y", "I'm  don't", " " * 300_000 + "x"):
        assert encode(t).tolist() == plain(t)


@pytest.mark.parametrize("n", [0, 1, 300, 60_000])
def test_solver_holds_every_piece(n):
    rng = np.random.default_rng(n)
    lengths = np.clip(rng.lognormal(4.5, 1.0, n).astype(int), 1, 256)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)))) if n else {}
    got = {}
    solution, bound = solve(histogram, 256)
    assert bound <= sum(n for _, n in solution) + 1e-6
    for config, copies in solution:
        assert sum(config) <= 256 and copies > 0
        for length in config:
            got[length] = got.get(length, 0) + copies
    assert got == histogram
    if n > 1000:
        assert sum(c for _, c in solution) <= 1.005 * sum(k * v for k, v in histogram.items()) / 256


def test_knapsack_and_best_fit():
    price = np.array([0.0, 1.0, 2.5, 2.9])
    assert knapsack(price)[0].tolist() == [0.0, 1.0, 2.5, 3.5]
    assert sum(c for _, c in best_fit(np.array([0, 2, 1, 2, 0]))) == 3 - 0


def fewest(lengths, capacity):
    """The fewest sequences by trying every packing (branch and bound, longest first)."""
    lengths, best = sorted(lengths, reverse=True), len(lengths)

    def go(i, spaces):
        nonlocal best
        if len(spaces) >= best:
            return
        if i == len(lengths):
            best = len(spaces)
            return
        for s in sorted(set(spaces)):
            if s >= lengths[i]:
                rest = list(spaces)
                rest.remove(s)
                go(i + 1, [*rest, s - lengths[i]])
        go(i + 1, [*spaces, capacity - lengths[i]])
    go(0, [])
    return best


def test_small_programs_against_every_packing():
    rng, worse = np.random.default_rng(4), 0
    for _ in range(60):
        capacity = int(rng.integers(8, 40))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 11))).tolist()
        solution, bound = solve({x: lengths.count(x) for x in set(lengths)}, capacity)
        got, want = sum(n for _, n in solution), fewest(lengths, capacity)
        assert sorted(x for c, n in solution for x in c * n) == sorted(lengths) and all(sum(c) <= capacity for c, _ in solution)
        assert bound <= want + 1e-6 and want <= got <= want + 1
        worse += got > want
    assert worse <= 3


@pytest.mark.parametrize("draw,gap", [(lambda r: r.integers(330, 400, 50_000), 0.002), (lambda r: np.clip(r.lognormal(5.5, 0.9, 400_000), 1, 1024).astype(int), 0.002),
                                      (lambda r: np.clip(r.normal(420, 120, 200_000), 1, 1023).astype(int), 0.008)])
def test_gap_to_the_lower_bound(draw, gap):
    counts = np.bincount(draw(np.random.default_rng(1)), minlength=1025)
    solution, bound = solve({i: int(n) for i, n in enumerate(counts) if n}, 1024)
    held = np.zeros(1025, dtype=np.int64)
    for config, n in solution:
        np.add.at(held, list(config), n)
    assert (held == counts).all() and bound <= sum(n for _, n in solution) <= bound * (1 + gap)
