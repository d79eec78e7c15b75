import random
import re

import numpy as np
import pytest
import xxhash

from kinfold.llm.components import components
from kinfold.llm.simhash import bucket_links, covering_masks, fingerprint, link_edges, mask_tree, near_duplicates, signed


def brute_fingerprint(text, n=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=2):
    """ids -> smallest id reachable, comparing every pair."""
    ids = list(range(len(fps)))
    root = ids[:]

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in ids:
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in ids]


def brute(rows):
    rows = sorted(rows, key=lambda r: r[0])
    fps = [brute_fingerprint(t) for _, t in rows]
    return sorted((i, f"{fp:016x}", rows[c][0]) for (i, _), fp, c in zip(rows, fps, brute_components(fps)))


def test_fingerprint_of_odd_texts():
    long = " ".join(f"w{i % 5000}" for i in range(70_000))
    for t in (None, "", "  \t", "One", "one TWO", "a b c", "é ß A", "a b c d", "x\x1fy z w", long):
        assert fingerprint(None if t is None else t.encode(), 3) == brute_fingerprint(t)


def test_table_against_all_pairs(spark, sample):
    df, rows = sample
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(df).collect())
    assert got == brute([(r.doc_id, r.text) for r in rows])


def test_masks_cover_every_pair_within_the_radius():
    masks = covering_masks(list(range(64)), 2)
    for i in range(64):
        for j in range(64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)
    for level in mask_tree(2, 3)[1:]:
        assert max(64 - bin(m).count("1") for _, m in level) <= 12


@pytest.mark.parametrize("limit", [1, 3, 1024])
def test_hot_buckets_lose_no_link(spark, limit):
    rng = random.Random(limit)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice((1, 1, 2, 3, 4)))) for _ in range(150)} | {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(fps, key=signed)
    edges = link_edges(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), 2, bucket_rows=limit)
    assert all(bin((e.a ^ e.b) & (2 ** 64 - 1)).count("1") <= 2 for e in edges.collect())
    roots = {r.node: r.root for r in components(edges).collect()}
    got = [roots.get(signed(f), signed(f)) for f in fps]
    want = brute_components(fps)
    assert got == [signed(fps[c]) for c in want]


def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (5, 4), (5, 4)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 10 for i in range(10, 61)}, **{i: 100 for i in range(100, 140)}, 4: 4, 5: 4}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(make_docs):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (9, None), (8, " "), (None, "q r s t u")]
    got = sorted(((r.doc_id, r.component_id) for r in near_duplicates(make_docs(rows).selectExpr("*", "lang as fingerprint", "lang as fp", "lang as id")).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (3, 3), (None, 3), (9, 8), (8, 8), (None, None)], key=str)
    assert near_duplicates(make_docs([])).count() == 0
