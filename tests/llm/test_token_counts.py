import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinfold.llm.token_counts import field_tokens, section_tokens


@pytest.fixture(scope="module")
def encode():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False)


def brute(text, encode, separator="\n", rule="start"):
    """[(start, end, tokens, crossing)] in characters, token by token from the tokenizer's own offsets."""
    bounds, at = [0], 0
    while (k := text.find(separator, at)) >= 0:
        at = k + len(separator)
        bounds.append(at)
    if bounds[-1] != len(text) or len(bounds) == 1:
        bounds.append(len(text))
    out = [[a, b, 0, 0] for a, b in zip(bounds, bounds[1:])]
    for a, b in encode(text).offsets:
        shares = [min(b, e) - max(a, s) for s, e, *_ in out]
        held = [i for i, s in enumerate(shares) if s > 0]
        own = held[0] if rule == "start" else held[-1] if rule == "end" else max(held, key=lambda i: shares[i])
        out[own][2] += 1
        out[own][3] += len(held) > 1
    return [tuple(x) for x in out]


@pytest.mark.parametrize("rule", ["start", "end", "most"])
def test_table_against_the_tokenizers_offsets(sample, encode, rule):
    df, rows = sample
    got = {}
    for r in section_tokens(df, rule=rule).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.start, r.end, r.n_tokens, r.n_crossing))
    crossing = 0
    for r in rows:
        own = [x[1:] for x in sorted(got[r.doc_id])]
        assert sum(x[2] for x in own) == len(encode(r.text).ids)
        assert own[0][0] == 0 and own[-1][1] == len(r.text.encode()) and all(a[1] == b[0] for a, b in zip(own, own[1:]))
        if r.text.isascii():  # characters are bytes
            assert own == brute(r.text, encode, rule=rule)
        crossing += sum(x[3] for x in own)


@pytest.mark.parametrize("rule,want", [("start", [2, 0, 0, 1]), ("end", [1, 0, 0, 2]), ("most", [1, 0, 1, 1])])
def test_a_token_over_several_boundaries(make_docs, encode, rule, want):
    text = "a\n\n\nb"
    got = [(r.n_tokens) for r in section_tokens(make_docs([(1, text)]), rule=rule).orderBy("section").collect()]
    assert [x[2] for x in brute(text, encode, rule=rule)] == got and sum(got) == len(encode(text).ids)


def test_odd_rows(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "\n"), (None, "x y"), (2, "")]).withColumn("section", F.lit("s"))
    got = sorted(((r.doc_id, r.section, r.start, r.end, r.n_tokens) for r in section_tokens(docs).collect()), key=str)
    assert got == sorted([(1, 0, 0, 0, 0), (2, 0, 0, 0, 0), (2, 0, 0, 0, 0), (3, 0, 0, 1, 1), (None, 0, 0, 3, 2)], key=str)
    assert section_tokens(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        section_tokens(docs, rule="half")


def test_fields_add_up(spark, encode):
    df = spark.createDataFrame([(1, "hello wor", "ld again", None), (2, "", "x", "y")], "id long, a string, b string, field string")
    got = {(r.id, r.field): r.n_tokens for r in field_tokens(df, "id", ["a", "b", "field"]).collect()}
    assert set(got) == {(i, f) for i in (1, 2) for f in ("a", "b", "field")}
    assert sum(v for (i, _), v in got.items() if i == 1) == len(encode("hello wor\x1eld again\x1e\x1e").ids)
