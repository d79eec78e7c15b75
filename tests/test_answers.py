"""STR4-STR9, CND6-CND7, RSH3 (FIXTURES 2.3, 2.5)."""

import pytest
from pyspark.sql import functions as F

from kinfold.functions import ALL_ANSWERS, FIRST_ANSWER, clean_answer, extract_answers, level_score, reverse_scored

CASES = [
    ('["true"]', ["Yes"], ["Yes"]),
    ('["True"]', ["Yes"], ["Yes"]),
    ('["a","b"]', ["a"], ["a", "b"]),
    ('["a", "b"]', ["a"], ['a", "b']),
    ('[""]', [""], [None]),
    ("[5]", [None], [None]),
    (None, [None], [None]),
]


@pytest.mark.parametrize("raw,first,every", CASES)
def test_answers(spark, raw, first, every):
    df = spark.createDataFrame([(raw,)], "answers string")
    for pat, exp in ((FIRST_ANSWER, first), (ALL_ANSWERS, every)):
        got = (df.select(F.explode_outer(extract_answers("answers", pat)).alias("a"))
               .select(clean_answer("a").alias("c")).collect())
        assert [r.c for r in got] == exp, pat


def test_likert_and_reverse(spark):
    rows = [("1. q", "fairly often", 3), ("4. q", "fairly often", 1), ("45. q", "never", 0), ("7. q", "huh", None),
            (None, "very often", 4)]
    df = spark.createDataFrame([r[:2] for r in rows], "q string, a string")
    got = df.select(reverse_scored(level_score("a"), "q").alias("s")).collect()
    assert [r.s for r in got] == [r[2] for r in rows]
