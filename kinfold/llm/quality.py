"""Quality rules with risk-controlled thresholds (operator 12).

A rule compares two counts of a text with a cutoff in thousandths; its cutoffs go from loose to strict. Which cutoffs are
applied is learnt for each stratum from labelled texts, so that texts labelled good are falsely rejected with a rate of at
most ``risk``, in all strata at once, with probability 1 - ``failure`` at least:

1. The labelled texts of a stratum are split into two halves by a hash of the text. Copies of a text count once, as one trial (good if any
   copy is labelled good).
2. The first half orders the steps (rule, cutoff): those that reject the fewest good texts first, then those that reject the most bad
   ones. A step that does not reject more bad than good texts there is left out. The n-th policy applies the first n steps.
3. The second half, the holdout, tests the policies in that order. A policy that rejects k of the m good texts of the holdout is safe
   if a binomial (m, ``risk``) has at most k successes with probability ``failure`` / strata or less, which is the
   same as its exact (Clopper-Pearson) upper bound being at most ``risk``. Testing stops at the first policy that is not safe.
   Every policy is fixed before the holdout is seen and no test follows a failed one, so a stratum needs no correction inside;
   the strata share ``failure`` (Bonferroni).

The last safe policy is applied to all texts of the stratum. A stratum with too few good labels (about log(strata / failure) / risk)
certifies nothing, and only the base rules reject its texts.

All counts are sums over all documents; what reaches the driver is the number of strata, and the binomial tails are computed in tasks. Tables by
stratum have at most a few dozen rows each, and are broadcast only after a check of their size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.operators.joins import checked_broadcast

from .batches import parts, written
from .words import repeated_positions, word_numbers

# Characters that count as symbols; white space; window of repeated words.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
REPEAT_WINDOW = 8

#: Rule -> (counted, measured against, sign, cutoffs in thousandths from loose to strict). Sign 1 rejects above a cutoff, -1 below.
RULES: dict[str, tuple[str, str, int, tuple[int, ...]]] = {
    "symbols": ("n_symbols", "word_chars", 1, (400, 300, 200, 150, 100, 70, 50, 30, 20, 10)),
    "repeated_lines": ("n_dup_lines", "n_lines", 1, (800, 600, 500, 400, 300, 250, 200, 150)),
    "repeated_words": ("n_repeat_words", "n_words", 1, (250, 200, 150, 100)),
    "long_words": ("word_chars", "n_words", 1, (14000, 12000, 10000, 9000, 8000, 7500, 7000, 6500)),
    "short_words": ("word_chars", "n_words", -1, (1500, 2000, 2500, 3000, 3500, 4000, 4200)),
    "few_words": ("n_different", "n_words", -1, (20, 50, 100, 150, 200, 300, 400)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_different")


def counts_of(text: str | None) -> tuple[int, ...]:
    """``COUNTS`` of one text; a NULL text has none of anything."""
    text = text or ""
    data = text.encode()
    words = data.split()  # of bytes: exactly the white space of BLANKS
    lines = [line for line in data.split(b"\n") if line.strip()]
    ids, different = word_numbers(words)
    repeated = int(repeated_positions(ids, REPEAT_WINDOW).sum()) if different < len(words) else 0
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated,
            len(lines), different)


def text_counts(rows: DataFrame, columns: str) -> DataFrame:
    """``rows`` (a struct ``row`` of ``columns``, and a text) with ``COUNTS`` of the texts, row by row where they are read."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            counts = zip(*map(counts_of, part.column(1).to_pylist()), strict=True)
            yield pa.record_batch([part.column(0), *[pa.array(c, pa.int64()) for c in counts]], names=["row", *COUNTS])

    return rows.mapInArrow(scan, f"row {columns}, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failure(least_words: int, most_repeated: int) -> Column:
    """Whether a text fails the base rules: too few words, or more than ``most_repeated`` % of them in repeated windows."""
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


def _level(rule: str) -> Column:
    """How many cutoffs of the rule reject the text."""
    counted, against, sign, cutoffs = RULES[rule]
    hits = [sign * 1000 * F.col(counted) > sign * c * F.col(against) for c in cutoffs]
    return sum((h.cast("int") for h in hits[1:]), hits[0].cast("int"))


def binomial_tail(m: np.ndarray, k: np.ndarray, risk: float) -> list[float]:
    """P(X <= k) of a binomial (m, risk), each from its own terms."""
    out = []
    for n, most in zip(m.tolist(), k.tolist(), strict=True):
        j = np.arange(1, most + 1, dtype=np.float64)
        logs = np.cumsum(np.concatenate([[n * math.log1p(-risk)], np.log((n - j + 1) / j) + math.log(risk) - math.log1p(-risk)]))
        out.append(min(1.0, float(np.exp(logs).sum())))
    return out


def safe_policies(labelled: DataFrame, risk: float, failure: float) -> DataFrame:
    """(stratum, steps): the steps (rule, level) of the last safe policy of each stratum, one row for each stratum with any.

    ``labelled`` has a row for each labelled text: stratum, digest, good, and ``level_<rule>`` for each rule.
    """
    levels = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"level_{r}").alias("level")) for r in RULES])
    texts = labelled.withColumn("holdout", F.substring("digest", 1, 1) >= "8")
    by_rule = texts.where(~F.col("holdout")).select("stratum", "good", F.inline(levels)).where("level > 0")
    seen = by_rule.groupBy("stratum", "rule", "level").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    # a text that a strict cutoff of a rule rejects is rejected by every stricter one: add up from the strictest level
    steps = seen.select("stratum", "rule", F.explode(F.sequence(F.lit(1), "level")).alias("level"), "good", "bad")
    steps = steps.groupBy("stratum", "rule", "level").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).where("bad > good")
    order = Window.partitionBy("stratum").orderBy(F.col("good"), F.col("bad").desc(), "rule", "level")
    steps = written(steps.select("stratum", "rule", "level", F.row_number().over(order).alias("policy")))

    held = texts.where("holdout AND good")
    sizes = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("m"))
    # the first policy that rejects a held-out good text
    met = held.select("stratum", "digest", F.inline(levels)).where("level > 0").withColumnRenamed("level", "reached")
    small = checked_broadcast(steps.withColumnsRenamed({"stratum": "s", "rule": "r"}))
    first = met.join(small, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("rule") == F.col("r")) & (F.col("level") <= F.col("reached")))
    first = first.groupBy("stratum", "digest").agg(F.min("policy").alias("policy")).groupBy("stratum", "policy").agg(F.count(F.lit(1)).alias("lost"))
    upto = Window.partitionBy("stratum").orderBy("policy").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tested = steps.join(first, ["stratum", "policy"], "left").withColumn("lost", F.sum(F.coalesce("lost", F.lit(0))).over(upto)).join(sizes, "stratum")

    def tails(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(p=binomial_tail(b["m"].to_numpy(), b["lost"].to_numpy(), risk))

    tested = tested.select("stratum", "policy", "rule", "level", "m", "lost").mapInPandas(
        tails, "stratum string, policy int, rule string, level int, m long, lost long, p double")
    strata = max(1, labelled.select("stratum").distinct().count())
    safe = tested.withColumn("fails", F.max((F.col("p") > failure / strata).cast("int")).over(upto)).where("fails = 0")
    return safe.groupBy("stratum").agg(F.collect_list(F.struct("rule", "level")).alias("steps"))


def judge_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", label_id: str = "doc_id",
                  label_col: str = "quality", risk: float = 0.05, failure: float = 0.1, least_words: int = 20, most_repeated: int = 30) -> DataFrame:
    """Quality counts, base verdict and learnt verdict of every text, one row for each row of ``df``.

    The result has the id, ``COUNTS``, base_failed, kept (false if base_failed or if a safe step of the text's stratum
    rejects it), stratum and rejected_by (names of the rules that reject it, comma-joined by name; empty if none).

    Labels are 1 (good) or 0; a label row with a NULL id or label is not used, and of several labels of an id the largest counts. Texts that fail the base
    rules are no trials. NULL and empty texts have no words and fail the base rules. A NULL stratum is a stratum of its own, the empty text.
    Rows with one id and different texts are judged each by its own text; both take the labels of the id. Without labels, and for
    an empty table, nothing is learnt. Other columns of ``df`` and ``labels`` are not read.
    """
    text = F.col(text_col).cast("string")
    known = F.struct(F.col(id_col).alias("id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
                     F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("digest"))
    rows = df.select(known.alias("row"), text.alias("text"))
    counted = text_counts(rows, rows.schema["row"].dataType.simpleString()).select("row.*", *COUNTS)
    counted = written(counted.withColumn("base_failed", base_failure(least_words, most_repeated)))

    marks = labels.select(F.col(label_id).alias("label_id"), F.col(label_col).cast("int").alias("label")).where("label_id IS NOT NULL AND label IS NOT NULL")
    marks = marks.groupBy("label_id").agg((F.max("label") == 1).alias("good"))
    trials = counted.where("NOT base_failed").select("id", "stratum", "digest", *[_level(r).alias(f"level_{r}") for r in RULES]).distinct()
    labelled = trials.join(marks, F.col("id") == F.col("label_id")).groupBy("stratum", "digest").agg(
        F.max("good").alias("good"), *[F.first(f"level_{r}").alias(f"level_{r}") for r in RULES])
    policy = checked_broadcast(written(safe_policies(written(labelled), risk, failure)).withColumnRenamed("stratum", "s"))

    reached = F.create_map(*[x for r in RULES for x in (F.lit(r), _level(r))])
    judged = counted.join(policy, F.col("stratum") == F.col("s"), "left").withColumn("reached", reached)
    hit = F.filter(F.coalesce("steps", F.array().cast("array<struct<rule:string,level:int>>")), lambda s: F.element_at("reached", s["rule"]) >= s["level"])
    rejected = F.when(F.col("base_failed"), F.lit("")).otherwise(F.array_join(F.array_sort(F.array_distinct(F.transform(hit, lambda s: s["rule"]))), ","))
    return judged.select(F.col("id").alias(id_col), *COUNTS, "base_failed", rejected.alias("rejected_by"), "stratum").withColumn(
        "kept", ~F.col("base_failed") & (F.col("rejected_by") == ""))
