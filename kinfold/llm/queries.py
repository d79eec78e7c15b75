"""The queries of this subpackage: each runs one operator over its whole table and derives the columns of its contract."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest
from .batches import crc_bucket
from .decontam import decontaminate
from .html_text import extract
from .langid import identify
from .packing import pack
from .periodic import find_runs
from .quality import judge_quality
from .secret_scan import scan_secrets
from .simhash import near_duplicates
from .suffix_dedup import remove_repeats
from .token_counts import section_tokens
from .toxicity import score_toxicity
from .whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans", "n_novel")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, radius=2)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = crc_bucket("doc_id", 5) == 0
    return identify(docs, docs.where(~held_out)).withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_table(spark, sf_dir, "documents"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window_words=13, one_in=20)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), crc_bucket("label_id", 4) != 2, threshold=0.3)
    return scored.select("doc_id", (crc_bucket("doc_id", 4) == 2).alias("held_out"), "score", "predicted", "evidence")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), capacity=1024, end_id=2)


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), every=50, k=5)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), carry=True).select("row.page_id", "row.url", "text", "n_chars")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_tokens(_table(spark, sf_dir, "documents"), separator="\n", rule="start")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"), components=8)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), stratum_col="lang", risk=0.05, failure=0.1)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


def repeating_tail(doc_id: str, words: list[bytes]) -> list[bytes]:
    """``words``, of every tenth id (by its crc32) with a tail that repeats a piece of the text: the contract's periodic cases."""
    h, n = zlib.crc32(doc_id.encode()), len(words)
    if h % 10 or not n:
        return words
    a = h // 10 % n
    period = 1 + (n - a) // (3 + h // 10 % 8)
    return words[:a] + [words[a + i % period] for i in range(n - a)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(_table(spark, sf_dir, "documents"), shortest=12, rewrite=repeating_tail, digests=True)
    return found.drop("n_words")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_simhash": op2_simhash,
    "op3_language_id": op3_language_id,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_html_text": op9_html_text,
    "op10_token_counts": op10_token_counts,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_quality_rules": op12_quality_rules,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": pipeline,
}

#: DuckDB SQL of the queries that SQL can express; the others are tested against brute force.
SQL: dict[str, str] = {}

SQL["op4_suffix_dedup"] = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (
  SELECT doc_id, s, md5(substring(h, 2 * s + 1, 200)) AS m
  FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) / 2 - 99 AS BIGINT))) AS s FROM docs WHERE length(h) >= 200)
),
dup AS (SELECT doc_id, s FROM win QUALIFY row_number() OVER (PARTITION BY m ORDER BY doc_id, s) > 1),
mark AS (
  SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS fresh FROM dup
),
isle AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS n FROM mark),
span AS (SELECT doc_id, n, min(s) AS a, max(s) + 100 AS b FROM isle GROUP BY doc_id, n),
gap AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM span
  UNION ALL SELECT doc_id, max(b), NULL FROM span GROUP BY doc_id
),
kept AS (
  SELECT g.doc_id, string_agg(substring(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' ORDER BY a) AS k
  FROM gap g JOIN docs d ON g.doc_id = d.doc_id GROUP BY g.doc_id
),
sums AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM docs d LEFT JOIN sums s ON d.doc_id = s.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op5_decontamination"] = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS t
  FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
doc_windows AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS t
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, sizes WHERE len(w) >= size)
),
found AS (SELECT doc_id, i, d.size, item FROM doc_windows d JOIN item_windows b ON d.size = b.size AND d.t = b.t),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id
"""

SQL["op12_quality_rules"] = r"""
WITH rules(rule, sign, cutoffs) AS (VALUES
  ('symbols', 1, [400, 300, 200, 150, 100, 70, 50, 30, 20, 10]),
  ('repeated_lines', 1, [800, 600, 500, 400, 300, 250, 200, 150]),
  ('repeated_words', 1, [250, 200, 150, 100]),
  ('long_words', 1, [14000, 12000, 10000, 9000, 8000, 7500, 7000, 6500]),
  ('short_words', -1, [1500, 2000, 2500, 3000, 3500, 4000, 4200]),
  ('few_words', -1, [20, 50, 100, 150, 200, 300, 400])),
step AS (SELECT rule, sign, unnest(cutoffs) AS cutoff, unnest(range(1, len(cutoffs) + 1)) AS level FROM rules),
doc AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ')) AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM doc WHERE len(w) >= 8)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM win WHERE c > 1) GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, stratum, md5(t) AS digest, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines, len(list_distinct(w)) AS n_different
  FROM doc d LEFT JOIN rep r ON d.doc_id = r.doc_id),
base AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted),
measured AS (
  SELECT doc_id, stratum, digest, rule,
         CASE rule WHEN 'symbols' THEN n_symbols WHEN 'repeated_lines' THEN n_dup_lines WHEN 'repeated_words' THEN n_repeat_words
                   WHEN 'few_words' THEN n_different ELSE word_chars END AS x,
         CASE rule WHEN 'symbols' THEN word_chars WHEN 'repeated_lines' THEN n_lines ELSE n_words END AS y
  FROM base, rules WHERE NOT base_failed),
fired AS (SELECT doc_id, stratum, digest, m.rule, level FROM measured m JOIN step s ON m.rule = s.rule AND sign * 1000 * x > sign * cutoff * y),
marks AS (SELECT doc_id, max(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
trial AS (SELECT stratum, digest, bool_or(good) AS good FROM base JOIN marks USING (doc_id) WHERE NOT base_failed GROUP BY stratum, digest),
fires AS (SELECT DISTINCT stratum, digest, rule, level FROM fired),
seen AS (
  SELECT stratum, rule, level, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad
  FROM trial JOIN fires USING (stratum, digest) WHERE digest < '8' GROUP BY ALL),
steps AS (
  SELECT stratum, rule, level, row_number() OVER (PARTITION BY stratum ORDER BY good, bad DESC, rule, level) AS policy FROM seen WHERE bad > good),
lost AS (
  SELECT stratum, policy, count(*) AS n FROM (
    SELECT stratum, digest, min(policy) AS policy FROM trial JOIN fires USING (stratum, digest) JOIN steps USING (stratum, rule, level)
    WHERE digest >= '8' AND good GROUP BY stratum, digest) GROUP BY ALL),
sizes AS (SELECT stratum, count(*) AS m FROM trial WHERE digest >= '8' AND good GROUP BY stratum),
tested AS (
  SELECT s.stratum, rule, level, s.policy, m, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY s.stratum ORDER BY s.policy) AS BIGINT) AS k
  FROM steps s JOIN sizes z ON s.stratum = z.stratum LEFT JOIN lost l ON s.stratum = l.stratum AND s.policy = l.policy),
judged AS (
  SELECT *, list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(m + 1) - lgamma(j + 1) - lgamma(m - j + 1) + j * ln(0.05) + (m - j) * ln(0.95))))
            <= 0.1 / (SELECT count(DISTINCT stratum) FROM trial) AS safe
  FROM tested),
certified AS (SELECT stratum, rule, level FROM judged QUALIFY bool_and(safe) OVER (PARTITION BY stratum ORDER BY policy)),
rejected AS (
  SELECT doc_id, string_agg(rule, ',' ORDER BY rule) AS rejected_by
  FROM (SELECT DISTINCT doc_id, rule FROM fired JOIN certified USING (stratum, rule, level)) GROUP BY doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rejected_by IS NULL AS kept, coalesce(rejected_by, '') AS rejected_by
FROM base b LEFT JOIN rejected r ON b.doc_id = r.doc_id
"""

SQL["op13_periodic_runs"] = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(3988292384, v // 2) ELSE v // 2 END))) AS h
  FROM documents),
tail AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a FROM doc),
planted AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM tail),
word AS (SELECT doc_id, i, CASE WHEN i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END AS t
         FROM (SELECT *, unnest(range(n)) AS i FROM planted)),
six AS (
  SELECT doc_id, i, string_agg(t, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS g,
         count(*) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS size
  FROM word),
twice AS (SELECT doc_id, i, g FROM six WHERE size = 6 QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
pair AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM twice x JOIN twice y ON x.doc_id = y.doc_id AND x.g = y.g AND x.i < y.i),
isle AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM pair),
stretch AS (SELECT doc_id, q, min(i) AS s, max(i) + 6 + q AS e FROM isle GROUP BY doc_id, q, part),
cand AS (SELECT * FROM stretch WHERE e - s >= greatest(12, 2 * q)),
run AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM cand d WHERE d.doc_id = c.doc_id AND d.q < c.q AND d.s <= c.s AND d.e >= c.e)),
best AS (SELECT doc_id, s, e - s AS len, q FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY e - s DESC, s, q) = 1),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS txt FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, e)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY i) AS txt FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.len AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period,
       CAST(1000 * b.len // b.q AS BIGINT) AS exponent_milli, sha256(coalesce(l.txt, '')) AS runs_sha256, sha256(coalesce(k.txt, '')) AS collapsed_sha256
FROM doc d LEFT JOIN best b ON d.doc_id = b.doc_id LEFT JOIN listed l ON d.doc_id = l.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
