"""Enrollment summary (API4: AGG1-AGG4, SET2, RSH1-RSH2).

R's ``n_distinct`` counts NA as a value, and indexing by an NA condition injects an NA id; ``setdiff``
matches NA with NA (quirk Q8). All nine counts come from two grouped passes over the union of the two
participant tables, keyed by (kind, id) for participant and family ids, so each id is shuffled once and
no count-distinct expansion or cross join is needed. NULL ids form their own group, which is how NA
counts as one value.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.casting import safe_divide
from kinfold.operators.reshape import pivot_wide, unpivot_long

# Levels of the summary, in output order, and the metric prefix of each.
LEVELS = (("individuals", "pt_"), ("families", "fam_"), ("founders", "founders_"))
SUMMARY_METRICS = ("enrolled", "invited", "dropped", "avg_enrolled_fam_size", "enroll_pct")


def _sql_text(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _flag_aggs(conds: dict[str, str]) -> list[Column]:
    """Per key: presence on each side and, per condition (SQL text), whether some row of the
    all-participants side met it (``_t``) or had it undetermined (``_u``); same for the active side
    (``_ct``/``_cu``). Written as SQL text: one parse per aggregate instead of many builder calls."""
    aggs = ["max(__side = 'a') AS in_a", "max(__side = 'c') AS in_c"]
    for name, cond in conds.items():
        aggs += [
            f"max(__side = 'a' AND coalesce({cond}, false)) AS {name}_t",
            f"max(__side = 'a' AND ({cond}) IS NULL) AS {name}_u",
            f"max(__side = 'c' AND coalesce({cond}, false)) AS {name}_ct",
            f"max(__side = 'c' AND ({cond}) IS NULL) AS {name}_cu",
        ]
    return [F.expr(a) for a in aggs]


def _count_distinct_na(kind: str, name: str, alias: str) -> Column:
    """n_distinct(id[cond]) with R's NA rules, from per-id flags of one key kind."""
    rows = f"__kind = '{kind}'"
    return F.expr(f"count_if({rows} AND __key IS NOT NULL AND {name}_t) + "
                  f"coalesce(CAST(max({rows} AND ({name}_u OR (__key IS NULL AND {name}_t))) AS INT), 0) AS {alias}")


def _setdiff_na(kind: str, name: str, alias: str) -> Column:
    """length(setdiff(id[cond on all], id[cond on active])) with NA matching NA."""
    rows = f"__kind = '{kind}'"
    na_x = f"coalesce(max({rows} AND ({name}_u OR (__key IS NULL AND {name}_t))), false)"
    na_y = f"coalesce(max({rows} AND ({name}_cu OR (__key IS NULL AND {name}_ct))), false)"
    return F.expr(f"count_if({rows} AND __key IS NOT NULL AND {name}_t AND NOT {name}_ct) + "
                  f"CASE WHEN {na_x} AND NOT {na_y} THEN 1 ELSE 0 END AS {alias}")


def enrollment_counts(all_people: DataFrame, active_people: DataFrame | Column, id_col: str = "patient_id",
                      family_col: str = "FamilyID", position_col: str = "fam_pos",
                      status_col: str = "invitation_status", enrolled_value: str = "enrolled",
                      founder_position: int = 1) -> DataFrame:
    """One row with the nine counts pt_/fam_/founders_ x enrolled/invited/dropped (AGG1, AGG2).

    ``active_people`` is either the second table of the study code or, when it is a subset of
    ``all_people``, the Column that selects it; the condition form reads the participants once.
    Each row is exploded into (side, kind, key) rows -- side 'a' (all) and 'c' (active), kind 'pt'
    (participant id) and 'fam' (family id, as text so both kinds share one key column) -- and a single
    grouping on (kind, key) gives every flag.
    """
    cols = [id_col, family_col, position_col, status_col]
    if isinstance(active_people, Column):
        sides = F.when(F.coalesce(active_people, F.lit(False)), F.array(F.lit("a"), F.lit("c"))) \
            .otherwise(F.array(F.lit("a")))
        tagged = all_people.select(*cols, F.explode(sides).alias("__side"))
    else:
        tagged = (all_people.select(*cols).withColumn("__side", F.lit("a"))
                  .unionByName(active_people.select(*cols).withColumn("__side", F.lit("c"))))
    kinds = F.array(F.struct(F.lit("pt").alias("__kind"), F.col(id_col).cast("string").alias("__key")),
                    F.struct(F.lit("fam").alias("__kind"), F.col(family_col).cast("string").alias("__key")))
    rows = tagged.select(*cols, "__side", F.inline(kinds))
    enrolled = f"`{status_col}` = {_sql_text(enrolled_value)}"
    founder = f"`{position_col}` = {int(founder_position)}"
    flags = rows.groupBy("__kind", "__key").agg(*_flag_aggs(
        {"enr": enrolled, "all": "true", "fnd": founder, "fnd_enr": f"({founder}) AND ({enrolled})"}))
    return flags.agg(
        _count_distinct_na("pt", "enr", "pt_enrolled"),
        _count_distinct_na("pt", "all", "pt_invited"),
        _setdiff_na("pt", "all", "pt_dropped"),
        _count_distinct_na("fam", "enr", "fam_enrolled"),
        _count_distinct_na("fam", "all", "fam_invited"),
        _setdiff_na("fam", "all", "fam_dropped"),
        _count_distinct_na("pt", "fnd_enr", "founders_enrolled"),
        _count_distinct_na("pt", "fnd", "founders_invited"),
        _setdiff_na("pt", "fnd", "founders_dropped"),
    )


def enrollment_summary(all_people: DataFrame, active_people: DataFrame | Column,
                       last_updated: Column | _dt.datetime | None = None, **names) -> DataFrame:
    """3 rows (individuals, families, founders) x (last_updated, level, enrolled, invited, dropped,
    avg_enrolled_fam_size, enroll_pct) (API4). Ratios with a zero divisor are NULL (quirk Q15)."""
    if last_updated is None:
        stamp = F.lit(None).cast("timestamp_ntz")
    elif isinstance(last_updated, Column):
        stamp = last_updated
    else:  # from text: a Python datetime literal would pass through the session time zone
        stamp = F.lit(last_updated.isoformat(sep=" ")).cast("timestamp_ntz")
    counts = enrollment_counts(all_people, active_people, **names)
    wide = counts.select(
        stamp.alias("last_updated"),
        *[F.col(c).cast("double").alias(c) for c in counts.columns],
        safe_divide(F.col("pt_enrolled"), F.col("fam_enrolled")).cast("double").alias("avg_enrolled_fam_size"),
        safe_divide(F.col("pt_enrolled"), F.col("pt_invited")).cast("double").alias("pt_enroll_pct"),
        safe_divide(F.col("fam_enrolled"), F.col("fam_invited")).cast("double").alias("fam_enroll_pct"),
        safe_divide(F.col("founders_enrolled"), F.col("founders_invited")).cast("double").alias("founders_enroll_pct"),
    )
    metric_cols = [c for c in wide.columns if c != "last_updated"]
    long = unpivot_long(wide, ["last_updated"], metric_cols, "metric", "value")
    level = None
    for name, prefix in LEVELS:
        test = F.col("metric").startswith(prefix)
        level = F.when(test, F.lit(name)) if level is None else level.when(test, F.lit(name))
    level = level.when(F.col("metric").startswith("avg_enrolled_fam_size"), F.lit("families"))
    long = long.withColumns({
        "level": level,
        "metric": F.regexp_replace("metric", "^(pt_|fam_|founders_)", ""),
    })
    wide3 = pivot_wide(long, ["last_updated", "level"], "metric", "value", SUMMARY_METRICS)
    order = F.array_position(F.array(*[F.lit(n) for n, _ in LEVELS]), F.col("level"))
    return wide3.orderBy(order).select("last_updated", "level", *SUMMARY_METRICS)
