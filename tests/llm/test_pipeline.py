"""The pipeline's stages against brute force on the small documents table, and its queries' shape."""

import os
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kinfold.llm.queries import QUERIES, SQL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_compare import compare, duck  # noqa: E402
from test_decontam import brute as brute_hits  # noqa: E402
from test_packing import check, plain  # noqa: E402, F401
from test_secrets import brute as brute_spans  # noqa: E402
from test_simhash import brute as brute_groups  # noqa: E402

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_one_after_the_other(spark, plain):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = STAGES["language_id"](spark, docs, SF)
    assert known.columns == docs.columns and set(rows(known)) <= set(rows(docs))
    assert known.count() >= 0.99 * docs.count()

    single = STAGES["simhash_near_dedup"](spark, known, SF)
    first = {i for i, _, c in brute_groups([(r.doc_id, r.text) for r in known.collect()]) if i == c}
    assert rows(single) == [r for r in rows(known) if r[0] in first]

    clean = STAGES["benchmark_decontamination"](spark, single, SF)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {h[0] for h in brute_hits([(r.doc_id, r.text) for r in single.collect()], items) if h[4]}
    assert rows(clean) == [r for r in rows(single) if r[0] not in bad]

    safe = STAGES["secret_scan"](spark, clean, SF)
    before = {r.doc_id: r for r in clean.collect()}
    changed = 0
    for r in safe.collect():
        old = before.pop(r.doc_id)
        assert not brute_spans(r.text) and (r.text == old.text or r.n_chars == len(r.text)) and r.lang == old.lang
        changed += r.text != old.text
        assert (r.text != old.text) or not brute_spans(old.text)
    assert not before and safe.columns == docs.columns

    check(STAGES["best_fit_packing"](spark, safe, SF).collect(), [(r.doc_id, r.text) for r in safe.collect()], plain)


def test_language_stage_drops_what_it_did_not_learn(spark, make_docs):
    from test_langid import FOREIGN
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").union(make_docs([(10 ** 6 + i, t) for i, t in enumerate(FOREIGN)], None))
    kept = {r.doc_id for r in STAGES["language_id"](spark, docs, SF).collect()}
    assert max(kept) < 10 ** 6 and len(kept) >= 0.99 * (docs.count() - len(FOREIGN))


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    same = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows(got.select(same)) == rows(docs.select(same))


def test_odd_rows_in_every_stage(spark, make_docs):
    docs = make_docs([(1, "the word and the other of it is"), (1, "the word and the other of it is"), (2, None), (3, ""), (4, "12 34"), (None, "a text that has no id at all, of its own"),
                      (5, 'my token = "abcdef1234567" here and the rest of it'), (6, "the " * 40_000)])
    odd = docs.select("*", F.lit("x").alias("row"), F.lit(1).alias("_kept"), F.lit(2).alias("component_id"), F.lit(3).alias("redacted"), F.lit(4).alias("score"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        odd = stage(spark, odd, SF)
        assert odd.columns[:5] == docs.columns, name
    left = {r.doc_id: r.text for r in odd.collect()}
    assert len(left) == odd.count() and 2 not in left and 4 not in left and "[SECRET]" in left[5] and left[6] == "the " * 40_000
    assert STAGES["best_fit_packing"](spark, odd, SF).where("doc_id = 6").agg(F.sum("length")).first()[0] > 40_000
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_rows_of_null_or_repeated_ids_are_judged_one_by_one(spark, make_docs):
    texts = ["a first text of its own about rivers and mountains", "quite another one that tells of ships at sea", "the third has bread, butter and tea in it"]
    docs = make_docs([(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, "a last text under the same number, on the moon"), (None, texts[2])])
    single = STAGES["simhash_near_dedup"](spark, docs, SF)
    assert rows(single) == sorted((tuple(r) for r in docs.collect()[:4]), key=str)
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(r.text.split()) >= 13)
    docs = make_docs([(1, texts[0]), (1, item), (None, texts[1]), (None, item)])
    assert sorted(r.text for r in STAGES["benchmark_decontamination"](spark, docs, SF).collect()) == sorted(texts[:2])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    import __spark_entry__ as entry
    assert name in entry.oracle_sql()
    assert compare(spark, duck(SF), name, SF)["status"] == "match"


def test_query_columns(spark):
    want = {
        "op1": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"], "op2": ["doc_id", "fingerprint", "component_id"],
        "op3": ["doc_id", "held_out", "lang_pred", "score"], "op4": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op5": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"], "op6": ["doc_id", "held_out", "score", "predicted"],
        "op7": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"], "op8": ["query_id", "rank", "vec_id", "score"],
        "op9": ["page_id", "url", "text", "n_chars"]}
    for name, f in QUERIES.items():
        if name.split("_")[0] in want:
            cols = want[name.split("_")[0]]
            assert f(spark, SF).columns[:len(cols)] == cols
