import hashlib
import random

import numpy as np
import pytest

from kinfold.llm.periodic import Extensions, all_runs, find_runs, runs_of
from kinfold.llm.queries import op13_periodic_runs, repeating_tail
from kinfold.llm.words import repeated_positions, window_numbers
from kinfold.plans.tables import table


def brute_runs(word, shortest):
    """Runs by comparing every pair of positions; a stretch counts for its smallest period only."""
    n, out = len(word), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and word[j] == word[j + q]:
                j += 1
            length = j + q - i
            if length >= max(shortest, 2 * q):
                part = word[i:j + q]
                if not any(all(part[k] == part[k + r] for k in range(length - r)) for r in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_in(text):
    return [w for w in (text or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]


def brute(words, shortest=12):
    runs = brute_runs(words, shortest)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    gone = {i for a, size, q in runs for i in range(a + q, a + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{a},{size},{q}\n" for a, size, q in runs)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], listed, kept)


def random_word(rng):
    n = rng.randint(0, 60)
    word = [rng.randrange(rng.choice((1, 2, 2, 3, 4))) for _ in range(n)]
    if n > 3 and rng.random() < 0.5:
        p, a = rng.randint(1, n), rng.randrange(n)
        word = [word[a + (i - a) % p] if i >= a and a + (i - a) % p < n else word[i] for i in range(n)]
    return word


@pytest.mark.parametrize("shortest", [4, 12])
def test_runs_against_all_pairs(shortest):
    rng = random.Random(shortest)
    for _ in range(1500):
        word = random_word(rng)
        assert [tuple(r) for r in runs_of(np.array(word, dtype=np.int64), shortest).tolist()] == brute_runs(word, shortest)


def test_all_runs_of_known_words():
    fib = [0, 1]
    words = [[0], [0, 1]]
    while len(words[-1]) < 60:
        words.append(words[-1] + words[-2])
    for word in (words[-1], [0] * 40, [0, 1] * 20 + [1] * 5, list(range(30)), fib):
        got = sorted(map(tuple, all_runs(np.array(word, dtype=np.int64), 2).tolist()), key=lambda r: (r[0], r[2]))
        assert got == brute_runs(word, 2)


def test_extensions_against_plain_comparison():
    rng = random.Random(5)
    for _ in range(200):
        ids = np.array([rng.randint(1, 3) for _ in range(rng.randint(2, 40))])
        lce, n = Extensions(ids), len(ids)
        pairs = [(a, b) for a in range(n + 1) for b in range(n + 1) if a != b]
        got = lce.common(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
        for (a, b), size in zip(pairs, got.tolist()):
            k = 0
            while max(a, b) + k < n and ids[a + k] == ids[b + k]:
                k += 1
            assert size == k


def test_windows_are_compared_exactly():
    rng = random.Random(3)
    for size in (1, 2, 3, 6, 7, 8):
        ids = np.array([rng.randrange(3) for _ in range(300)])
        seen = {}
        want = [seen.setdefault(tuple(ids[i:i + size].tolist()), len(seen)) for i in range(len(ids) - size + 1)]
        got = window_numbers(ids, size).tolist()
        assert len(got) == len(want) and len(set(zip(got, want))) == len(set(got)) == len(set(want))
    assert not len(window_numbers(np.arange(5), 6)) and not repeated_positions(np.arange(5), 8).any()


def test_query_against_brute_force(spark):
    rows = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()

    def digest(t):
        return hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for r in rows:
        words = words_in(r.text)
        if len(words) <= 700:
            *numbers, listed, kept = brute([w.decode() for w in repeating_tail(str(r.doc_id), [w.encode() for w in words])])
            want[r.doc_id] = (*numbers, digest(listed), digest(kept))
    got = {r[0]: tuple(r)[1:] for r in op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows) and len(want) > 150 and sum(v[0] > 0 for v in want.values()) > 5
    assert {i: got[i] for i in want} == want


def test_odd_rows(spark, make_docs):
    loop = "a b  c\n" * 9
    rows = [(1, None), (2, ""), (3, " \t\r"), (None, loop), (5, loop), (5, loop + "x"), (6, "é " * 12), (7, "z" * 500_000), (8, "one\x1ctwo " * 30), (9, "w " * 100_000)]
    df = make_docs(rows).selectExpr("*", "lang as n_runs", "lang as start", "lang as _text", "lang as runs")
    got = [tuple(r) for r in find_runs(df).collect()]
    assert sorted(map(str, got)) == sorted(str((i, len(words_in(t)), *brute(words_in(t)))) if i != 9 else str((9, 100_000, 1, 0, 100_000, 1, 100_000_000, "0,100000,1\n", "w")) for i, t in rows)
    assert find_runs(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        find_runs(df, shortest=7)


def test_rewrite_follows_the_stated_rule():
    assert repeating_tail("", list("abcdefg")) == list("abcabca")  # crc32 of nothing is 0: a = 0, period 1 + 7 // 3
    assert repeating_tail("1", list("abcdefg")) == list("abcdefg") and repeating_tail("", []) == []
