import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from kinfold.llm.queries import op12_quality_rules
from kinfold.llm.quality import COUNTS, RULES, binomial_tail, counts_of, judge_quality

LABELS = "doc_id long, quality int, toxic int"


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines, again = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)], 0
    for i, line in enumerate(lines):
        again += line in lines[:i]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated), len(lines), len(set(words)))


def test_counts_against_plain_code(sample):
    texts = [r.text for r in sample[1]] + [None, "", " \n\t", "é ü x", "a\x1cb c\x85d", "x y\n x y\nx y\n", "a b c d e f g h " * 3, "# a|b <c>\r\n*"]
    for t in texts:
        assert counts_of(t) == brute_counts(t)


def test_binomial_tail():
    for m, k in ((1, 0), (20, 3), (77, 0), (400, 12), (50, 50)):
        want = sum(math.comb(m, j) * 0.05 ** j * 0.95 ** (m - j) for j in range(k + 1))
        assert abs(binomial_tail(np.array([m]), np.array([k]), 0.05)[0] - want) < 1e-12
    assert binomial_tail(np.array([10 ** 6]), np.array([50_000]), 0.05)[0] < 0.52


def brute_verdicts(docs, labels, risk, failure):
    """(doc_id, kept, rejected_by) by loops over rows (doc_id, text, lang)."""
    import hashlib
    marks = defaultdict(list)
    for i, q in labels:
        if i is not None and q is not None:
            marks[i].append(q)

    def levels(t):
        c = dict(zip(COUNTS, brute_counts(t)))
        return {r: sum(s * 1000 * c[x] > s * cut * c[y] for cut in cuts) for r, (x, y, s, cuts) in RULES.items()}

    def base(t):
        c = brute_counts(t)
        return c[0] < 20 or 100 * c[4] > 30 * c[0]
    trials = defaultdict(dict)
    for i, t, lang in docs:
        if marks.get(i) and not base(t):
            d = hashlib.md5((t or "").encode()).hexdigest()
            good = max(marks[i]) == 1 or trials[lang or ""].get(d, (False,))[0]
            trials[lang or ""][d] = (good, levels(t))
    safe = {}
    for s, texts in trials.items():
        first = [v for d, v in texts.items() if d < "8"]
        held = [v for d, v in texts.items() if d >= "8" and v[0]]
        steps = []
        for r, (_, _, _, cuts) in RULES.items():
            for k in range(1, len(cuts) + 1):
                good, bad = (sum(g == want and lv[r] >= k for g, lv in first) for want in (True, False))
                if bad > good:
                    steps.append((good, -bad, r, k))
        safe[s], applied = [], []
        for _, _, r, k in sorted(steps) if held else []:
            applied.append((r, k))
            lost = sum(any(lv[a] >= b for a, b in applied) for _, lv in held)
            if sum(math.comb(len(held), j) * risk ** j * (1 - risk) ** (len(held) - j) for j in range(lost + 1)) > failure / len(trials):
                break
            safe[s] = list(applied)
    out = []
    for i, t, lang in docs:
        hit = sorted({r for r, k in safe.get(lang or "", []) if levels(t)[r] >= k}) if not base(t) else []
        out.append((i, not base(t) and not hit, ",".join(hit)))
    return out


def made_up(rng, n):
    docs, labels = [], []
    vocabulary = [f"word{i}" for i in range(400)]
    for i in range(n):
        bad = rng.random() < 0.3
        words = [rng.choice(vocabulary) for _ in range(rng.randint(15, 60))]
        if bad:
            words = [w + rng.choice(("", "##", "|<>|", "$")) if rng.random() < 0.8 else "q" for w in words]
        lang = rng.choice(("en", "en", "en", "de", None))
        docs.append((i, " ".join(words) + rng.choice(("", "\nx y\nx y")), lang))
        if rng.random() < 0.8:
            labels.append((i, int(not bad) if rng.random() < 0.98 else int(bad)))
    return docs, labels + [(None, 1), (3, None), (10 ** 9, 0)]


def test_verdicts_against_brute_force(spark):
    rng = random.Random(4)
    docs, labels = made_up(rng, 700)
    docs += [(i, t, lang) for i, t, lang in docs[:40]] + [(701, docs[5][1], "en"), (None, docs[6][1], "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").selectExpr("*", "lang as id", "lang as stratum", "lang as n_words", "lang as kept")
    marks = spark.createDataFrame(labels, "doc_id long, quality int").selectExpr("*", "doc_id as label_id", "quality as good")
    for risk, failure in ((0.1, 0.1), (0.02, 0.05)):
        got = [(r.doc_id, r.kept, r.rejected_by) for r in judge_quality(df, marks, risk=risk, failure=failure).collect()]
        want = brute_verdicts(docs, labels, risk, failure)
        assert sorted(map(str, got)) == sorted(map(str, want))
        if risk == 0.1:
            assert sum(r != "" for _, _, r in want) > 50


def test_false_rejections_are_limited(spark):
    """Labels without any relation to the rules: at most a tenth of the draws may lose more than 5 % of good texts."""
    over = 0
    for seed in range(5):
        rng = random.Random(seed)
        docs, _ = made_up(rng, 400)
        docs = [(i, t, "en") for i, t, _ in docs]
        labels = [(i, rng.randint(0, 1)) for i, _, _ in docs]
        got = judge_quality(spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        judged = [r for r in got if not r.base_failed]
        over += sum(not r.kept for r in judged) > 0.05 * len(judged)
    assert over <= 1


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op12_quality_rules(spark, sf).collect()}
    quality = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in got]
    good = [g for g, q in quality if q == 1 and not g.base_failed]
    bad = [g for g, q in quality if q == 0]
    assert sum(g.kept for g in good) >= 0.95 * len(good) and sum(g.kept for g in bad) < 0.2 * len(bad)


def test_odd_rows(spark, make_docs):
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [(1, None), (2, ""), (None, "a " * 30), (4, "# " * 30), (4, long), (5, " ".join(f"x{i}" for i in range(25)))]
    none = spark.createDataFrame([], LABELS)
    got = {(r.doc_id, r.n_words): (r.base_failed, r.kept) for r in judge_quality(make_docs(rows, None), none).collect()}
    assert got == {(1, 0): (True, False), (2, 0): (True, False), (None, 30): (True, False), (4, 30): (True, False), (4, 60_000): (True, False), (5, 25): (False, True)}
    assert judge_quality(make_docs([]), none).count() == 0
    assert judge_quality(make_docs([]), spark.createDataFrame([(1, 1, 0)], LABELS)).count() == 0
