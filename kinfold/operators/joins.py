"""Joins with the study semantics (JN1-JN6): NULL keys match NULL keys, clashing names get suffixes.

Broadcast policy: a side is broadcast only after a bounded row count proves it small
(``checked_broadcast``); otherwise the plan keeps a shuffle join and AQE (skew-join splitting and
runtime broadcast of small shuffle outputs) re-plans it at run time.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20

_HOW = {"left": "left", "inner": "inner", "full": "full", "right": "right", "left_semi": "left_semi",
        "left_anti": "left_anti"}


def is_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and, written as JSON, at most ``max_bytes`` bytes.

    One job that reads at most ``max_rows + 1`` rows (``limit`` stops early).
    """
    width = F.octet_length(F.to_json(F.struct(*[F.col(_q(c)) for c in df.columns])))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when a bounded check (``is_small``) allows it, else ``df`` unchanged, which leaves the join to AQE.

    Persist ``df`` before calling when it is expensive to compute, so the check and the join read it once.
    """
    if max_rows is None:
        return df
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def local_copy(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``df`` computed once and given back as a broadcast local table if it has at most ``max_rows`` rows and, written as JSON, at most
    ``max_bytes`` bytes; else ``df`` itself.

    For tables that are small by their nature (a dictionary, bins of a histogram) and read by several branches of a plan:
    none of them computes it again. One job, which sends the rows to the driver only if both bounds hold.
    """
    cols = F.struct(*[F.col(_q(c)).alias(c) for c in df.columns])
    held = df.limit(max_rows + 1).select(cols.alias("r"), F.octet_length(F.to_json(cols)).alias("size"))
    size, n = F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))
    rows = held.agg(F.when((n <= max_rows) & (size <= max_bytes), F.collect_list("r")).alias("rows")).first()["rows"]
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if rows is not None else df


def _q(name: str) -> str:
    return f"`{name}`"


def join_by(left: DataFrame, right: DataFrame, on: Sequence[str] | dict[str, str], how: str = "left",
            suffix: tuple[str, str] = (".x", ".y"), null_safe: bool = True, one_per_key: bool = False) -> DataFrame:
    """dplyr-style join. A full join is planned as ``full_join_split`` (skew-safe, same rows), or, when the caller
    knows that both sides have few rows for a key (``one_per_key``: aggregated inputs), as a native full outer join, which
    reads each side once.

    * ``on``: list of shared key names, or {left_name: right_name}. The output keeps the left key names;
      for full/right joins the key is ``coalesce(left, right)``.
    * Non-key columns present on both sides get ``suffix[0]`` / ``suffix[1]``.
    * ``null_safe``: NULL keys match each other (dplyr default). Spark still plans an equi-join.
    """
    if how not in _HOW:
        raise ValueError(f"how must be one of {sorted(_HOW)}")
    if how == "full" and not one_per_key:
        return full_join_split(left, right, on, suffix, null_safe)
    return _join(left, right, on, how, suffix, null_safe)


def full_join_split(left: DataFrame, right: DataFrame, on: Sequence[str] | dict[str, str],
                    suffix: tuple[str, str] = (".x", ".y"), null_safe: bool = True,
                    left_keys: DataFrame | None = None) -> DataFrame:
    """Full outer join as ``left join`` + the right rows whose key never occurs on the left.

    A native full outer join can neither broadcast a side nor be split by AQE's skew handling, so one hot
    key (a busy day, a NULL id) lands in one task. The left join can be split (or broadcast), and the
    anti join only needs the distinct left keys, which aggregate map-side to a small table.
    ``left_keys`` (distinct left keys, named like the right keys) may be passed in when the caller can
    build them more cheaply than re-reading ``left`` (``fold_join`` does).
    """
    pairs = list(on.items()) if isinstance(on, dict) else [(k, k) for k in on]
    right_key_names = [rk for _, rk in pairs]
    matched = _join(left, right, on, "left", suffix, null_safe)
    if left_keys is None:
        left_keys = left.select(*[F.col(_q(lk)).alias(rk) for lk, rk in pairs]).distinct()
    only_right = _join(right, left_keys, right_key_names, "left_anti", suffix, null_safe)
    # rename right keys to the left names and right columns to their suffixed names, as in ``matched``
    left_rest = {c for c in left.columns if c not in [lk for lk, _ in pairs]}
    sel = [F.col(_q(rk)).alias(lk) for lk, rk in pairs]
    sel += [F.col(_q(c)).alias(c + suffix[1] if c in left_rest else c)
            for c in right.columns if c not in right_key_names]
    return matched.unionByName(only_right.select(*sel), allowMissingColumns=True)


def _join(left: DataFrame, right: DataFrame, on: Sequence[str] | dict[str, str], how: str,
          suffix: tuple[str, str], null_safe: bool) -> DataFrame:
    pairs = list(on.items()) if isinstance(on, dict) else [(k, k) for k in on]
    left_keys = [lk for lk, _ in pairs]
    right_keys = [rk for _, rk in pairs]
    left_rest = [c for c in left.columns if c not in left_keys]
    right_rest = [c for c in right.columns if c not in right_keys]
    clash = set(left_rest) & set(right_rest)

    # rename only what must change: clashing names, and the right keys (dropped after the join)
    tmp = {rk: f"__rk{i}" for i, rk in enumerate(right_keys)}
    lren = {c: c + suffix[0] for c in left_rest if c in clash and suffix[0]}
    rren = {**{c: c + suffix[1] for c in right_rest if c in clash}, **tmp}
    lft = left.withColumnsRenamed(lren) if lren else left
    rgt = right.withColumnsRenamed(rren)

    conds = []
    for lk, rk in pairs:
        lc, rc = lft[_q(lk)], rgt[_q(tmp[rk])]
        conds.append(lc.eqNullSafe(rc) if null_safe else lc == rc)
    cond = functools.reduce(lambda a, b: a & b, conds)
    joined = lft.join(rgt, cond, _HOW[how])
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("full", "right"):
        joined = joined.withColumns({lk: F.coalesce(lft[_q(lk)], rgt[_q(tmp[rk])]) for lk, rk in pairs})
    return joined.drop(*tmp.values())


def fold_join(frames: Sequence[DataFrame], on: Sequence[str], how: str = "full",
              suffix: tuple[str, str] = (".x", ".y"), null_safe: bool = True, one_per_key: bool = False) -> DataFrame:
    """Left fold of ``join_by`` over any number of frames (JN5); ``one_per_key`` as there.

    For full joins the distinct keys seen so far are kept as their own small table, built from each
    input's key column: every step then reads the accumulated result once, so the work grows linearly
    with the number of inputs instead of doubling at each step.
    """
    if not frames:
        raise ValueError("no frames to join")
    if how != "full" or one_per_key:
        return functools.reduce(lambda acc, nxt: join_by(acc, nxt, on, how, suffix, null_safe, one_per_key), frames[1:], frames[0])
    keys = list(on)
    acc = frames[0]
    seen = frames[0].select(*keys).distinct()
    for nxt in frames[1:]:
        acc = full_join_split(acc, nxt, keys, suffix, null_safe, left_keys=seen)
        seen = seen.unionByName(nxt.select(*keys)).distinct()
    return acc
