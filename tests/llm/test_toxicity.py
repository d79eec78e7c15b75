import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import toxicity
from kinfold.llm.batches import crc_bucket
from kinfold.llm.toxicity import STRENGTHS, Examples, Index, Vocabulary, score_toxicity


def terms(text):
    """Occurrences of words and marked beginnings, word by word."""
    out = Counter()
    for w in re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())):
        out[w] += 1
        if len(w) >= 5:
            out[b"^" + w[:5]] += 1
    return out


@pytest.mark.parametrize("limit", [3, 200_000])
def test_terms_of_batches(monkeypatch, limit):
    monkeypatch.setattr(toxicity, "WORDS", limit)
    texts = ["Loser, loser! LOSERS", None, "", "ab \u00e9t\u00e9 x9", "the fine the garden"] * 2
    vocabulary = sorted(set().union(*(terms(t) for t in texts)) - {b"garden"})
    known = Vocabulary({t: i for i, t in enumerate(vocabulary)})
    for part in (texts[:3], texts[3:], texts):
        text, at, n = known.counts([t and t.encode() for t in part])
        got = [Counter() for _ in part]
        for i, a, c in zip(text.tolist(), at.tolist(), n.tolist()):
            got[i][vocabulary[a]] = c
        assert got == [Counter({t: c for t, c in terms(x).items() if t != b"garden"}) for x in part]


@pytest.mark.parametrize("often", [2, 8, 10_000])
def test_block_max_search_is_exact(monkeypatch, often):
    monkeypatch.setattr(toxicity, "OFTEN", often)
    rng = np.random.default_rng(2)
    chance = 1.0 / np.arange(1, 41)

    def draw(n):
        rows = [sorted(rng.choice(40, rng.integers(0, 7), replace=False, p=chance / chance.sum()).tolist()) for _ in range(n)]
        row, at = np.repeat(np.arange(n), list(map(len, rows))), np.array([t for r in rows for t in r], dtype=np.int64)
        return row, at, rng.integers(1, 5, len(at))

    def dense(row, at, n, rows):
        out = np.zeros((rows, 40))
        out[row, at] = (1 + np.log(n)) * weight[at]
        return out / np.maximum(np.sqrt((out ** 2).sum(axis=1, keepdims=True)), 1e-300)
    weight = rng.random(40) + 0.5
    row, at, n = draw(500)
    index = Index(Examples(list(range(500)), rng.integers(0, 2, 500), row, at, n, 40, (1.0, 1.0)), weight)
    held = dense(row, at, n, 500)
    row, at, n = draw(300)
    queries = dense(row, at, n, 300)
    size, best, cosines = index.nearest(row, at, queries[row, at], 300, 9)
    for i in range(300):
        true = np.sort(held @ queries[i])[::-1][:9]
        got = [index.ids[j] for j in best[i, :size[i]]]
        assert size[i] == (true > 0).sum() and np.allclose(cosines[i, :size[i]], true[true > 0], atol=1e-6)
        assert np.allclose(held[got] @ queries[i], cosines[i, :size[i]], atol=1e-6) and len(set(got)) == size[i]


def brute(docs, labels, learn, strength, k=15):
    """(score, cosines) of every document by loops over dictionaries."""
    counts = {i: terms(t) for i, t in docs}
    y = {i: v for i, v in labels if learn(i) and i in counts}
    n = len(docs)
    df = Counter(t for _, text in docs for t in terms(text))
    toxic, clean = [i for i in y if y[i]], [i for i in y if not y[i]]
    weight = {}
    for t in set().union(*(counts[i] for i in y)):
        a, b = sum(t in counts[i] for i in toxic), sum(t in counts[i] for i in clean)
        c, d = len(toxic) - a, len(clean) - b
        below = (a + b) * (c + d) * len(toxic) * len(clean)
        chi = math.sqrt((a * d - b * c) ** 2 * len(y) / below) if below else 0.0
        weight[t] = (math.log((1 + n) / (1 + df[t])) + 1) * (1 + strength * chi)

    def vector(c):
        v = {t: (1 + math.log(x)) * weight[t] for t, x in c.items() if t in weight}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}
    vectors = {i: vector(counts[i]) for i in y}
    rate = len(toxic) / len(y)
    out = {}
    for i, _ in docs:
        q = vector(counts[i])
        near = sorted(((sum(x * vectors[j].get(t, 0.0) for t, x in q.items()), y[j]) for j in y), reverse=True)[:k]
        near = [(s, v) for s, v in near if s > 0]
        vote = sum(s * s for s, _ in near)
        out[i] = ((sum(s * s * v for s, v in near) + 0.02 * rate) / (vote + 0.02), [s for s, _ in near])
    return out


def test_whole_result_against_brute_force(spark, make_docs):
    rng = np.random.default_rng(5)
    mild, harsh = [f"calm{i}word" for i in range(60)], [f"nasty{i}" for i in range(8)]

    def text(bad):
        words = rng.choice(mild, rng.integers(4, 25)).tolist() + (rng.choice(harsh, 3).tolist() if bad else [])
        return " ".join(words)
    kinds = [bool(rng.random() < 0.3) for _ in range(260)]
    docs = [(i, text(bad)) for i, bad in enumerate(kinds)] + [(900, None), (901, "zzz")]
    labels = [(i, int(kinds[i])) for i in range(200)]

    def learn(i):
        return zlib.crc32(str(i).encode()) % 4 != 2
    df = make_docs(docs)
    got = {r.doc_id: r for r in score_toxicity(df, spark.createDataFrame(labels, "doc_id long, toxic int"), crc_bucket("label_id", 4) != 2).collect()}
    matches = []
    for strength in STRENGTHS:
        want = brute(docs, labels, learn, strength)
        matches.append(all(got[i].score == pytest.approx(s, abs=2e-5) and got[i].evidence_cosine == pytest.approx(c, abs=1e-5) for i, (s, c) in want.items() if i < 900))
    assert sum(matches) == 1  # the strength that cross-validation chose
    assert got[900].score == got[901].score == pytest.approx(np.mean([v for i, v in labels if learn(i)])) and got[900].evidence == []


def test_held_out_quality_and_calibration(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = score_toxicity(docs, labels, crc_bucket("label_id", 4) != 2).join(labels, "doc_id").where(crc_bucket("doc_id", 4) == 2).collect()
    toxic, clean = [r for r in got if r.toxic == 1], [r for r in got if r.toxic == 0]
    assert len(toxic) > 50
    assert np.mean([r.predicted for r in toxic]) > 0.85 and np.mean([r.predicted for r in clean]) < 0.03
    assert all(0 <= r.score <= 1 and len(r.evidence) == len(r.evidence_cosine) for r in got)
    score, y = np.array([r.score for r in got]), np.array([r.toxic for r in got])
    assert ((score - y) ** 2).mean() < 0.03 < 0.25 * y.mean() * (1 - y.mean()) + 0.02
    assert abs(score.mean() - y.mean()) < 0.02  # the scores add up to the number of toxic texts
    for lo, hi in ((0, 0.2), (0.8, 1.01)):
        here = (score >= lo) & (score < hi)
        assert here.sum() > 50 and abs(score[here].mean() - y[here].mean()) < 0.06


def test_every_text_is_compared_with_clean_and_toxic_examples(spark, make_docs):
    clean = [(i, f"a fine day in the garden number{i}") for i in range(100)]
    toxic = [(100 + i, f"you awful fool number{i}") for i in range(20)]
    docs = make_docs([*clean, *toxic, (500, "the garden on a fine day"), (501, "what an awful fool")])
    labels = spark.createDataFrame([(i, 1, int(i >= 100)) for i, _ in clean + toxic], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in score_toxicity(docs, labels, F.lit(True)).collect()}
    assert len(got[500].evidence) == 15 and max(got[500].evidence) < 100 and got[500].predicted == 0
    assert min(got[501].evidence[:5]) >= 100 and got[501].predicted == 1
    assert all(r.evidence for r in got.values())


def test_odd_rows(spark, make_docs):
    learnt = [(i, f"you awful fool number {i}" if i % 2 else f"a fine day number {i}") for i in range(200)]
    rows = learnt + [(900, None), (901, ""), (902, "zzz"), (903, "awful fool " * 50_000), (None, "awful fool"), (903, "awful fool " * 50_000)]
    docs = make_docs(rows).withColumn("score", F.lit("s")).withColumn("label_id", F.lit(1)).withColumn("y", F.lit(1)).withColumn("id", F.lit(1))
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)] + [(None, 1, 1), (900, None, None), (903, 1, 1), (5, 1, 1), (777, 0, 1), (3, 0, 7)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in score_toxicity(docs, labels, F.lit(True)).collect()}
    assert [got[i].predicted for i in (903, None, 1, 0)] == [1, 1, 1, 0]
    assert got[900].score == got[901].score == got[902].score and got[900].evidence == []
    assert set(got[None].evidence) <= {i for i in range(200) if i % 2}  # 903 is longer than an example may be
    text = score_toxicity(docs.withColumn("doc_id", F.concat(F.lit("k"), "doc_id")), labels.withColumn("doc_id", F.concat(F.lit("k"), "doc_id")), F.lit(True))
    assert {r.predicted for r in text.where("doc_id = 'k1'").collect()} == {1}
    nothing = score_toxicity(docs, labels.limit(0), F.lit(True)).select("score").distinct().collect()
    assert [r.score for r in nothing] == [0.0]
    assert score_toxicity(docs.limit(0), labels, F.lit(True)).count() == 0
