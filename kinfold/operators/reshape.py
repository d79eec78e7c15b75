"""Reshaping and set operations (PRJ1, PRJ4, PRJ8, RSH1-RSH3, SET1-SET4, SMP1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def relocate(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Move ``first`` to the front and keep every other column in place (PRJ1)."""
    rest = [c for c in df.columns if c not in first]
    return df.selectExpr(*[f"`{c}`" for c in list(first) + rest])


def drop_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """Drop the columns from ``start`` to ``end`` inclusive, by position (PRJ4).

    Only meaningful when the input has an explicit schema: inferred JSON schemas sort columns by name
    (quirk Q7).
    """
    cols = df.columns
    i, j = cols.index(start), cols.index(end)
    if i > j:
        i, j = j, i
    return df.drop(*cols[i:j + 1])


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns (PRJ8); dates and timestamps are not numeric."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def unpivot_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "metric",
                 value: str = "value") -> DataFrame:
    """Wide -> long (RSH1); values are cast to double first so their types agree."""
    casted = df.select(*ids, *[F.col(f"`{v}`").cast("double").alias(v) for v in values])
    return casted.unpivot(list(ids), list(values), name, value)


def pivot_wide(df: DataFrame, ids: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long -> wide with the output columns given up front (RSH2); saves the job that finds them.

    Each (ids, name) pair must be unique, as in ``pivot_wider``; ``max`` then just picks that value.
    """
    return df.groupBy(*ids).pivot(name, list(names)).agg(F.max(value))


def bind_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """Row-bind by name; missing columns become NULL (SET1). Cast clashing types before calling."""
    out = frames[0]
    for nxt in frames[1:]:
        out = out.unionByName(nxt, allowMissingColumns=True)
    return out


def set_difference(x: DataFrame, y: DataFrame) -> DataFrame:
    """Distinct rows of ``x`` not in ``y``; NULL equals NULL (SET2, ``EXCEPT DISTINCT``)."""
    return x.subtract(y)


def dropped_keys(df: DataFrame, key: Column, keep: Column, where: Column | None = None,
                 name: str = "key") -> DataFrame:
    """Distinct ``key`` values of ``df`` that no kept row has: ``setdiff(df$key, df[keep, ]$key)`` in one
    pass (SET2 when the second table is a subset of the first). NULL is a key like any other; ``where``
    restricts both sides (rows where it is NULL contribute a NULL key, as R's indexing does)."""
    src = df
    k = key
    if where is not None:
        src = df.where(where | where.isNull())
        k = F.when(where, key)
    return (src.groupBy(k.alias(name)).agg(F.max(F.coalesce(keep, F.lit(False))).alias("__kept"))
            .where(~F.col("__kept")).select(name))


def masked_ids(df: DataFrame, id_col: str, cond: Column) -> DataFrame:
    """R's ``id[cond]``: rows where ``cond`` holds keep their id, rows where it is NULL give a NULL id (SET2)."""
    return df.where(cond | cond.isNull()).select(F.when(cond, F.col(id_col)).alias(id_col))


def distinct_in_order(df: DataFrame, col: str, order_col: str) -> DataFrame:
    """Distinct values of ``col`` with the position of their first appearance (SET4).

    Spark has no row order, so ``order_col`` (any column that orders the rows) stands in for it.
    """
    return df.groupBy(col).agg(F.min(order_col).alias("first_seen")).orderBy("first_seen")


def sample_rows(df: DataFrame, n: int, seed: int = 42, keys: Sequence[str] = ()) -> DataFrame:
    """n random rows (SMP1): those with the smallest md5 of the seed and their key (default: all columns).

    The sample depends on the seed and the rows alone, not on how they are spread; each partition keeps its n best, then
    one small merge.
    """
    cols = list(keys) or df.columns
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in cols])
    return df.withColumn("__order", F.md5(text.cast("binary"))).orderBy("__order", *[F.col(f"`{c}`") for c in cols]).limit(n).drop("__order")
