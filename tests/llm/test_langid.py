import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from kinfold.llm import langid
from kinfold.llm.batches import crc_bucket
from kinfold.llm.langid import Net, _gradients, identify, text_probabilities, train


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    h, c = 3, 2
    net = Net(["a", "b"], [rng.standard_normal((257, 3 * h)) * 0.5 for _ in (0, 1)], [rng.standard_normal((h, 3 * h)) * 0.5 for _ in (0, 1)], rng.standard_normal((2 * h + 1, c)))
    codes, labels = rng.integers(97, 100, (6, 4)), np.array([0, 1, 1, 0])
    codes[4:, 1] = langid.PAD
    for t in net.inputs:
        t[langid.PAD] = 0
    _, grads = _gradients(net, codes, labels)
    for name, param in (("out", net.out), ("states0", net.states[0]), ("states1", net.states[1]), ("inputs0", net.inputs[0][97:100]), ("inputs1", net.inputs[1][97:100])):
        g = grads[name][97:100] if name.startswith("inputs") else grads[name]
        for at in np.ndindex(*param.shape):
            old, eps = param[at], 1e-3
            param[at] = old + eps
            up, _ = _gradients(net, codes, labels)
            param[at] = old - eps
            down, _ = _gradients(net, codes, labels)
            param[at] = old
            assert abs((up - down) / (2 * eps) - g[at]) < 2e-3


def test_every_byte_counts_and_windows_join():
    net = train([b"the and of " * 30, "é à ça ".encode() * 30], ["en", "fr"], steps=60)
    texts = [b"the and of " * 50, b"", "é à ça ".encode() * 3, b"x"]
    p = text_probabilities(net, texts)
    assert p[1].tolist() == [0, 0] and np.allclose(p[[0, 2, 3]].sum(axis=1), 1, atol=1e-4)
    assert p[0].argmax() == 0 and p[2].argmax() == 1
    assert np.allclose(text_probabilities(net, texts[:1])[0], p[0], atol=1e-5)
    tail = text_probabilities(net, [texts[0] + "é à ça ".encode() * 40])
    assert tail[0, 0] < p[0, 0]  # the end of a text is read too


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rest = docs.where(crc_bucket("doc_id", 5) != 0)
    got = identify(docs.drop("lang", "source"), rest, carry=False).join(docs.select("doc_id", "lang"), "doc_id").where(crc_bucket("doc_id", 5) == 0).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got) and len(got) > 100
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.96
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark, make_docs):
    learned = make_docs([(i, "the cat and the dog of it") for i in range(20)]).union(make_docs([(i, "le chat été là ça é") for i in range(20, 40)], "fr"))
    learned = learned.union(make_docs([(50, None), (51, ""), (52, "x")], None))
    rows = [(1, None), (2, ""), (3, "123 ... !"), (4, "the dog " * 30_000), (None, "le chat été là ça é"), (4, "the dog " * 30_000)]
    docs = make_docs(rows).withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(2))
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, learned).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[4][0] == "en" and got[None][0] == "fr"
    assert identify(docs, learned.limit(0)).select("lang_pred").distinct().collect()[0][0] == "und"
    assert identify(docs.limit(0), learned).count() == 0
    assert identify(docs, learned, carry=True).select("row.*").columns == docs.columns


FOREIGN = [
    "В лесу родилась ёлочка, в лесу она росла, зимой и летом стройная зелёная была. Каждый охотник желает знать, где сидит фазан.",
    "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している。",
    "A magyar nyelv az uráli nyelvcsalád tagja, a finnugor nyelvek közé tartozó ugor nyelvek egyike. Legközelebbi rokonai a manysi és a hanti nyelv.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować.",
    "".join(random.Random(3).choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(300)),
    "".join(chr(random.Random(i).randrange(33, 1000)) for i in range(300)),
]


def test_texts_of_no_learned_language_are_told_apart(spark, make_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rest = docs.where(crc_bucket("doc_id", 5) != 0)
    odd = make_docs([(10 ** 6 + i, t) for i, t in enumerate(FOREIGN)], None)
    got = identify(docs.where(crc_bucket("doc_id", 5) == 0).union(odd), rest).collect()
    foreign = [r for r in got if r.doc_id >= 10 ** 6]
    clean = [r for r in got if r.doc_id < 10 ** 6 and r.lang_pred != "und"]
    assert len(foreign) == len(FOREIGN) and not any(r.known for r in foreign), [(r.foreign, r.known) for r in foreign]
    assert np.mean([r.known for r in clean]) > 0.99 and all(r.lang_pred in ("de", "en", "es", "fr", "und") for r in got)


def test_sample_is_split_by_language():
    labels = ["a"] * 10 + ["b"] * 3 + ["a"] * 2
    fit, held = langid.split_sample([b""] * 15, labels, 2)
    assert sorted(fit + held) == list(range(15)) and [labels[i] for i in held] == ["a", "a"] and held == [13, 14]


def test_few_labelled_texts_reject_nothing(spark, make_docs):
    learned = make_docs([(i, "the cat and the dog of it") for i in range(20)]).union(make_docs([(i, "le chat été là ça é") for i in range(20, 40)], "fr"))
    docs = make_docs([(i, t) for i, t in enumerate(FOREIGN)] + [(90, None), (91, "12 34"), (92, "the " * 40_000)])
    assert {r.doc_id: r.known for r in identify(docs, learned).collect()} == {**{i: True for i in range(len(FOREIGN))}, 90: False, 91: False, 92: True}
