import re

import pytest
from pyspark.sql import functions as F

from kinfold.llm.decontam import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, n=13):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (got := windows.get(tuple(w[i:i + size]))):
                    hit |= set(range(i, i + size))
                    found |= got
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def run(docs, items):
    return sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in decontaminate(docs, items).collect())


def test_table_against_brute_force(spark, sample):
    df, rows = sample
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in rows], [(r.item_id, r.text) for r in items.collect()])
    assert any(w[4] for w in want)
    assert run(df, items) == want


def test_odd_rows(spark, make_docs):
    item = " ".join(f"w{i}" for i in range(20))
    items = [(1, item), (2, "short Item"), (3, None), (4, ""), (10, item), (5, "the the the the the the the the the the the the the the")]
    docs = [(1, item.upper() + " tail"), (2, "a SHORT, item! short"), (3, None), (4, "..."), (6, "the " * 30), (7, "x " + " ".join(item.split()[3:17]) + " y" * 300),
            (8, "short-item " + "q " * 38), (9, "short item " + "q " * 39), (11, " ".join(item.split()[:12])), (12, "éshort item")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit(1))
    got = run(make_docs(docs).withColumn("n_hit", F.lit(7)).withColumn("window", F.lit("x")), table)
    assert got == brute(docs, items)
    assert {g[0]: g[4] for g in got}[8] and not {g[0]: g[4] for g in got}[9]


def test_repeated_rows_and_empty_tables(spark, make_docs):
    table = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert run(make_docs([(1, "one two three"), (1, "one two three"), (1, "other")]), table) == [(1, 1, 0, [], False), (1, 3, 3, ["1"], True)]
    assert run(make_docs([]), table) == []
    assert run(make_docs([(1, "one two three")]), table.limit(0)) == [(1, 3, 0, [], False)]
    assert decontaminate(make_docs([(None, "one two three")]), table).first().contaminated


@pytest.mark.parametrize("n", [1, 2, 5])
def test_other_window_sizes(make_docs, spark, n):
    docs = [(1, "a b a b c a b d"), (2, "b a a c"), (3, "c d e f g h")]
    items = [(1, "a b d"), (2, "c"), (3, "d e f g h i")]
    got = decontaminate(make_docs(docs), spark.createDataFrame(items, "item_id long, text string"), window_words=n)
    assert sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got.collect()) == brute(docs, items, n)
