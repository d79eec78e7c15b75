"""Two-group comparisons (API14: AGG13, AGG16-AGG18, CND8-CND9, STR12, JN6, RSH1).

**Quantiles** are exact (type 7, R's default) and move no values between tasks. A histogram per group, with bins that follow the
magnitude of the values, shows which bins hold the wanted ranks; only those bins are read again with bins of equal width
between their own smallest and largest value, until a bin is small enough to count its values. All bounds are exact
values of the data and all counts are integers, so any task that is run again finds the same bins.

**Kolmogorov-Smirnov and rank-sum** need the cumulative counts of both samples at every value, and so do the medians of a comparison. The
histogram by magnitude (one pass) brackets all of them: it gives the counts before each bin exactly, and the whole content of bins that hold a
single value. One more pass counts the values of the other bins, each summed up inside its bin; a bin with very many rows is cut again by
equal width between its own bounds first. Values are combined map-side before they are shuffled.

* Kolmogorov-Smirnov D = max |F_a - F_b|; p from the lattice paths when n_a * n_b < 10000, else asymptotic;
* Wilcoxon rank-sum W = R_a - n_a(n_a+1)/2 with average ranks of ties; p from the counts of the statistic when both samples have fewer than 50
  values and no two are equal, else the normal approximation with tie and 0.5 continuity correction.

These are R's defaults; ``exact=True`` takes the exact p wherever it is defined, ``exact=False`` never.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions.statfns import exact_ks_p_sql, exact_rank_sum_p_sql, kolmogorov_p_sql, p_text, signed_text, stars, two_sided_normal_p_sql
from kinfold.operators.joins import join_by, local_copy
from kinfold.operators.reshape import unpivot_long

BINS_PER_OCTAVE = 64   # bins for each doubling of the magnitude
SUB_BINS = 1024        # bins of equal width inside a bin that holds a wanted rank
COUNTED_ROWS = 200_000  # rows of a bin that is not cut again
LOCAL_ROWS = 200_000   # rows of a table of bins that may pass through the driver
# R computes exact p-values below these sizes (pairs of values; values of each sample).
EXACT_KS_PAIRS, EXACT_RANK_SUM = 10_000, 50
# Display names of the compared metrics in the study notebook (CND9).
METRIC_LABELS = {"resting_hr": "Resting Heart Rate (bpm)", "rmssd_detail": "RMSSD Detail (ms)"}
ANNOTATION_HEADROOM = 1.05  # label height = 1.05 x the metric's maximum
ANNOTATION_X = 1.5          # label centred between the two groups


def _clean(value: str) -> Column:
    """The value as a double; NaN counts as NULL."""
    v = F.col(value).cast("double")
    return F.when(F.isnan(v), F.lit(None)).otherwise(v)


def magnitude_bin(v: Column) -> Column:
    """Number of ``v``'s bin: never smaller for a larger value, 0 for 0 (NULL: NULL)."""
    size = F.floor(F.log2(F.abs(v)) * BINS_PER_OCTAVE) + 1100 * BINS_PER_OCTAVE  # positive for any double
    # infinite values are the outermost bins
    size = F.when(F.abs(v) == float("inf"), F.lit(3000 * BINS_PER_OCTAVE)).otherwise(size)
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * size).cast("long")


def width_bin(v: Column, lo: Column, hi: Column) -> Column:
    """Number of ``v``'s bin of equal width between ``lo`` and ``hi``; 0 when they are equal or NULL."""
    sub = F.when(hi - lo > 0, F.least(F.floor((v - lo) / (hi - lo) * SUB_BINS), F.lit(SUB_BINS - 1)))
    return F.coalesce(sub, F.lit(0)).cast("long")


def small_table(df: DataFrame) -> DataFrame:
    """A table of bins as a broadcast local table if it has at most ``LOCAL_ROWS`` rows; else as it is.

    Bins are few for each group, so only very many groups go on as an ordinary (shuffled) table.
    """
    return local_copy(df, LOCAL_ROWS)


def _ranked_bins(hist: DataFrame, g: list[str], within: list[str]) -> DataFrame:
    """(groups, bins): the bins of ``hist`` (columns bin, n, lo, hi) that hold a wanted rank, as one array of each group.

    ``wanted``: array of (id, rank in the surrounding bin); comes out with the rank in the bin found.
    """
    upto = Window.partitionBy(*g, *within).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = hist.withColumn("before", F.sum("n").over(upto) - F.col("n"))
    inside = F.transform(F.filter("wanted", lambda w: (w["rank"] > F.col("before")) & (w["rank"] <= F.col("before") + F.col("n"))),
                         lambda w: F.struct(w["id"].alias("id"), (w["rank"] - F.col("before")).alias("rank")))
    held = h.withColumn("wanted", inside).where(F.size("wanted") > 0)
    return held.groupBy(*g).agg(F.collect_list(F.struct("lo", "hi", "n", "wanted")).alias("bins"))  # two for each quantile at most


def quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str],
              histogram: DataFrame | None = None) -> DataFrame:
    """(groups, n, names...): exact type-7 quantiles of the non-NULL, non-NaN values of each group.

    Groups without values are left out. ``histogram``: (groups, bin, n, lo, hi) of all values by ``magnitude_bin``,
    if the caller has it already.
    """
    g = list(groups)
    vals = df.select(*g, _clean(value).alias("v")).where("v IS NOT NULL")
    if histogram is None:
        histogram = small_table(vals.groupBy(*g, magnitude_bin(F.col("v")).alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    whole = Window.partitionBy(*g)
    total = histogram.withColumn("total", F.sum("n").over(whole))
    wanted = []
    for i, p in enumerate(probs):
        first = (F.floor((F.col("total") - 1).cast("double") * F.lit(float(p))) + 1).cast("long")
        wanted += [F.struct(F.lit(2 * i).alias("id"), first.alias("rank")),
                   F.struct(F.lit(2 * i + 1).alias("id"), F.least(first + 1, F.col("total")).alias("rank"))]
    sizes = histogram.groupBy(*g).agg(F.sum("n").alias("total"))
    bins = small_table(_ranked_bins(total.withColumn("wanted", F.array(*wanted)).drop("total"), g, []))
    while (bins.select(F.explode("bins").alias("b")).where("b.lo < b.hi").agg(F.max("b.n")).first()[0] or 0) > COUNTED_ROWS:
        bins = small_table(_refined(vals, bins, g))
    # what is left: count the values of each bin
    held = _in_bins(vals, bins, g).groupBy(*g, "b", "v").agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy(*g, "b.lo").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = held.withColumn("upto", F.sum("c").over(upto))
    found = held.select(*g, "v", "c", "upto", F.explode("b.wanted").alias("w")).where("w.rank > upto - c AND w.rank <= upto")
    by_id = found.groupBy(*g).agg(*[F.max(F.when(F.col("w.id") == k, F.col("v"))).alias(f"__v{k}") for k in range(2 * len(probs))])
    out = join_by(by_id, sizes, g, how="inner", null_safe=True)
    cols = []
    for i, (p, name) in enumerate(zip(probs, names, strict=True)):
        pos = (F.col("total") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.col(f"__v{2 * i}"), F.col(f"__v{2 * i + 1}")
        cols.append(F.when((lo == hi) | (pos == F.floor(pos)), lo).otherwise(lo + (pos - F.floor(pos)) * (hi - lo)).alias(name))
    return out.select(*g, F.col("total").alias("n"), *cols)


def _in_bins(vals: DataFrame, bins: DataFrame, g: list[str]) -> DataFrame:
    """Values that lie in one of their group's bins, with that bin as the struct ``b``."""
    x = join_by(vals, bins, g, how="inner", null_safe=True) if g else vals.join(bins)
    hit = F.try_element_at(F.filter("bins", lambda b: (b["lo"] <= F.col("v")) & (F.col("v") <= b["hi"])), F.lit(1))
    return x.withColumn("b", hit).where("b IS NOT NULL").drop("bins")


def _refined(vals: DataFrame, bins: DataFrame, g: list[str]) -> DataFrame:
    """The wanted bins, cut again into bins of equal width between their own bounds."""
    x = _in_bins(vals, bins, g)
    hist = x.groupBy(*g, F.col("b"), width_bin(F.col("v"), F.col("b.lo"), F.col("b.hi")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    return _ranked_bins(hist.select(*g, F.col("b.lo").alias("outer"), "bin", "n", "lo", "hi", F.col("b.wanted").alias("wanted")), g, ["outer"])


def cumulative_counts(rows: DataFrame, groups: Sequence[str], histogram: DataFrame) -> DataFrame:
    """(groups, v, c_a, c_b, cum_a, cum_b): for each value of a group its rows in the samples ``__a`` and not ``__a``, and the rows
    with a value of at most v.

    ``rows`` holds (groups, __a, v) with non-NULL v, ``histogram`` the (groups, bin, n_a, n_b, lo, hi) of all of them by ``magnitude_bin``.
    One pass over ``rows``, and one more over the bins with over ``COUNTED_ROWS`` rows, if there are any.
    """
    g, leaf = list(groups), ["__bin", "__sub"]
    counted = [F.count_if(F.col("__a")).alias("n_a"), F.count_if(~F.col("__a")).alias("n_b")]
    bins = histogram.withColumnRenamed("bin", "__bin")
    crowded = (F.col("n_a") + F.col("n_b") > COUNTED_ROWS) & (F.col("lo") < F.col("hi"))
    full = small_table(bins.where(crowded).select(*g, "__bin", F.col("lo").alias("__lo"), F.col("hi").alias("__hi")))
    cut = not full.isEmpty()
    x = rows.withColumn("__bin", magnitude_bin(F.col("v")))
    leaves = bins.withColumn("__sub", F.lit(0).cast("long"))
    if cut:
        sub = width_bin(F.col("v"), F.col("__lo"), F.col("__hi"))
        inner = join_by(x, full, [*g, "__bin"], how="inner", null_safe=True).groupBy(*g, "__bin", sub.alias("__sub")).agg(*counted, F.min("v").alias("lo"), F.max("v").alias("hi"))
        leaves = leaves.where(~crowded).unionByName(small_table(inner))
        x = join_by(x, full, [*g, "__bin"], how="left", null_safe=True).withColumn("__sub", sub).drop("__lo", "__hi")
    else:
        x = x.withColumn("__sub", F.lit(0).cast("long"))
    before = Window.partitionBy(*g).orderBy(*leaf).rowsBetween(Window.unboundedPreceding, -1)
    leaves = small_table(leaves.withColumns({f"before_{c}": F.coalesce(F.sum(f"n_{c}").over(before), F.lit(0)) for c in "ab"}))
    alone = leaves.where("lo = hi").select(*g, F.col("lo").alias("v"), F.col("n_a").alias("c_a"), F.col("n_b").alias("c_b"),
                                           (F.col("before_a") + F.col("n_a")).alias("cum_a"), (F.col("before_b") + F.col("n_b")).alias("cum_b"))
    mixed = leaves.where("lo < hi").select(*g, *leaf, "before_a", "before_b")
    counts = join_by(x, mixed.drop("before_a", "before_b"), [*g, *leaf], how="left_semi", null_safe=True)
    counts = counts.groupBy(*g, *leaf, "v").agg(*[c.alias(n) for c, n in zip((F.count_if(F.col("__a")), F.count_if(~F.col("__a"))), ("c_a", "c_b"))])
    upto = Window.partitionBy(*g, *leaf).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    many = join_by(counts, mixed, [*g, *leaf], how="inner", null_safe=True)
    many = many.select(*g, "v", "c_a", "c_b", *[(F.col(f"before_{c}") + F.sum(f"c_{c}").over(upto)).alias(f"cum_{c}") for c in "ab"])
    return alone.unionByName(many)


def two_sample(df: DataFrame, group_col: str, a, b, value: str = "value", groups: Sequence[str] = ("metric",),
               exact: bool | None = None) -> DataFrame:
    """Per group: n (rows incl. NULL values), means and medians of the non-NULL values of samples ``a`` and
    ``b`` of ``group_col``; KS statistic and p; Wilcoxon W and p (AGG13, AGG16, AGG17).

    ``exact``: None takes R's rule (module docstring); True the exact p of any size (its work grows with n_a * n_b, that of the rank sum with
    its square) where it is defined; False the asymptotic p. ``df`` is read twice.
    """
    g = list(groups)
    side = F.col(group_col)
    rows = df.where(side.isin(a, b)).select(*g, (side == F.lit(a)).alias("__a"), _clean(value).alias("v"))
    # one pass: rows, sums and the magnitude histogram of both samples
    hist = small_table(rows.groupBy(*g, "__a", magnitude_bin(F.col("v")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("v").alias("s")))
    in_a, there = F.col("__a"), F.col("bin").isNotNull()

    def total(c: str, cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))

    sizes = hist.groupBy(*g).agg(
        total("n", in_a).alias("rows_a"), total("n", ~in_a).alias("rows_b"), F.max("hi").alias("max_val"),
        total("n", in_a & there).alias("n_a"), total("n", ~in_a & there).alias("n_b"),
        F.try_divide(F.sum(F.when(in_a, F.col("s"))), F.sum(F.when(in_a & there, F.col("n")))).alias("mean_a"),
        F.try_divide(F.sum(F.when(~in_a, F.col("s"))), F.sum(F.when(~in_a & there, F.col("n")))).alias("mean_b"))
    both = hist.where(there).groupBy(*g, "bin").agg(total("n", in_a).alias("n_a"), total("n", ~in_a).alias("n_b"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    cum = join_by(cumulative_counts(rows.where("v IS NOT NULL"), g, both), sizes.select(*g, "n_a", "n_b"), g, how="inner", null_safe=True)

    def ranked(c: str, rank: Column) -> Column:
        """The value with a rank (from 1) in a sample."""
        return F.max(F.when((F.col(f"cum_{c}") >= rank) & (F.col(f"cum_{c}") - F.col(f"c_{c}") < rank), F.col("v")))

    def middle(c: str) -> Column:
        low, high = ranked(c, F.floor((F.col(f"n_{c}") + 1) / 2)), ranked(c, F.floor(F.col(f"n_{c}") / 2) + 1)
        return F.when(low == high, low).otherwise(low + (high - low) / 2)

    t = F.col("c_a") + F.col("c_b")
    avg_rank = (F.col("cum_a") + F.col("cum_b") - t).cast("double") + (t + 1).cast("double") / 2
    few = F.lit(bool(exact)) if exact is not None else F.col("n_a") * F.col("n_b") < EXACT_KS_PAIRS
    parts = cum.groupBy(*g).agg(
        # a sample without values (n = 0) gives NULL statistics instead of an ANSI division error
        F.max(F.abs(F.try_divide(F.col("cum_a"), F.col("n_a")) - F.try_divide(F.col("cum_b"), F.col("n_b")))).alias("ks_statistic"),
        F.sum(F.col("c_a") * avg_rank).alias("rank_sum_a"),
        F.sum(F.pow(t.cast("double"), 3) - t.cast("double")).alias("ties"),  # double: t^3 overflows bigint
        middle("a").alias("median_a"), middle("b").alias("median_b"),
        # the pooled order, for samples with an exact p only: how many values are equal, from the smallest up
        F.transform(F.array_sort(F.collect_list(F.when(few, F.struct("v", t.cast("int").alias("t"))))), lambda x: x["t"]).alias("__equal"))
    out = join_by(sizes, parts, g, how="left", null_safe=True)
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = na + nb
    w = F.col("rank_sum_a") - na * (na + 1) / 2
    centred = w - na * nb / 2
    sigma = F.sqrt(na * nb / 12 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    z = F.try_divide(centred - F.signum(centred) * 0.5, sigma)  # all values tied: sigma = 0, p is NULL
    out = out.withColumns({"__ks_z": F.sqrt(F.try_divide(na * nb, n)) * F.col("ks_statistic"),
                           "wilcox_statistic": w, "__sigma": sigma, "__wz": z,
                           "__breaks": F.flatten(F.transform("__equal", lambda k: F.concat(F.array_repeat(F.lit(False), k - 1), F.array(F.lit(True)))))})
    exact_ks, exact_w = {None: (f"n_a * n_b < {EXACT_KS_PAIRS}", f"n_a < {EXACT_RANK_SUM} AND n_b < {EXACT_RANK_SUM}"), True: ("true", "true"), False: ("false", "false")}[exact]
    out = out.withColumns({
        "ks_p": F.expr(f"CASE WHEN n_a > 0 AND n_b > 0 AND {exact_ks} THEN {exact_ks_p_sql('ks_statistic', 'n_a', 'n_b', '__breaks')} "
                       f"ELSE {kolmogorov_p_sql('__ks_z')} END"),
        "wilcox_p": F.expr(f"CASE WHEN n_a > 0 AND n_b > 0 AND ties = 0 AND {exact_w} THEN {exact_rank_sum_p_sql('wilcox_statistic', 'n_a', 'n_b')} "
                           f"WHEN `__sigma` > 0 THEN {two_sided_normal_p_sql('__wz')} END"),
    })
    return out.select(*g, "rows_a", "rows_b", "n_a", "n_b", "mean_a", "mean_b", "median_a", "median_b",
                      "ks_statistic", "ks_p", "wilcox_statistic", "wilcox_p", "max_val")


def compare_groups(df: DataFrame, group_col: str, a, b, value_cols: Sequence[str],
                   labels: dict[str, str] | None = None, pre_aggregate_by: str | None = None,
                   digits: int = 9, exact: bool | None = None) -> DataFrame:
    """Year-over-year table of the study notebook (API14) from a wide table.

    ``pre_aggregate_by`` (Q18): a column (a day) over which each value column is averaged within its group first, so that
    a value repeated on every detail row of a day counts once. The averages are rounded to ``digits`` decimals: equal days
    then tie, whatever the order in which their rows were added up. ``df`` is then read once if the averages fit into a local table.
    ``exact`` as in ``two_sample``.

    Wide -> long over ``value_cols`` (RSH1), metric relabelled (unmapped names kept), then per metric:
    ``two_sample`` + differences (b - a), p texts, significance stars, the annotation text, and the
    annotation position (JN6: max value x 1.05).
    """
    df = df.where(F.col(group_col).isin(a, b))
    if pre_aggregate_by:
        df = small_table(df.groupBy(group_col, pre_aggregate_by).agg(*[F.round(F.avg(f"`{c}`"), digits).alias(c) for c in value_cols]))
    long = unpivot_long(df, [group_col], value_cols, "metric", "value")
    if labels:
        pairs = []
        for k, v in labels.items():
            pairs += [F.lit(k), F.lit(v)]
        long = long.withColumn("metric", F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("metric")),
                                                    F.col("metric")))
    res = two_sample(long, group_col, a, b, "value", ["metric"], exact)
    mean_diff = F.col("mean_b") - F.col("mean_a")
    median_diff = F.col("median_b") - F.col("median_a")
    res = res.withColumns({"mean_diff": mean_diff, "median_diff": median_diff})
    res = res.withColumns({
        "ks_p_formatted": p_text(F.col("ks_p")),
        "wilcox_p_formatted": p_text(F.col("wilcox_p")),
        "ks_significance": stars(F.col("ks_p")),
        "wilcox_significance": stars(F.col("wilcox_p")),
    })
    res = res.withColumn("annotation_text", F.concat(
        F.lit("Diff Median: "), signed_text(F.col("median_diff")),
        F.lit(" | Diff Mean: "), signed_text(F.col("mean_diff")), F.lit("\n"),
        F.lit("KS: "), F.col("ks_p_formatted"), F.lit(" "), F.col("ks_significance"), F.lit(" | "),
        F.lit("Wilcoxon: "), F.col("wilcox_p_formatted"), F.lit(" "), F.col("wilcox_significance")))
    return res.withColumns({"y_pos": F.col("max_val") * F.lit(ANNOTATION_HEADROOM),
                            "x_pos": F.lit(ANNOTATION_X)})


def box_numbers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Box-plot numbers per group (AGG18): n, quartiles (type 7), whiskers at the most extreme values
    within 1.5 x IQR of the box, and the number of values outside them. Groups without values are left out."""
    g = list(keys)
    quart = small_table(quantiles(df, g, value, [0.25, 0.5, 0.75], ["q1", "median", "q3"]))
    vals = df.select(*g, _clean(value).alias("v")).where("v IS NOT NULL")
    fences = join_by(vals, quart, g, how="inner", null_safe=True) if g else vals.join(quart)
    iqr = F.col("q3") - F.col("q1")
    low, high = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    inside = (F.col("v") >= low) & (F.col("v") <= high)
    return fences.groupBy(*g).agg(
        F.first("n").alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("v"))).alias("lower_whisker"), F.max(F.when(inside, F.col("v"))).alias("upper_whisker"),
        F.count_if(~inside).alias("n_outliers"))


def violin_density(df: DataFrame, keys: Sequence[str], value: str, points: int = 512, cut: float = 3.0, adjust: float = 1.0) -> DataFrame:
    """Outline of a violin per group (AGG18): (keys, n, bw, point, y, density, width), ``points`` rows for each group.

    A Gaussian kernel density of the finite values of each group at equal steps from ``cut`` bandwidths below the smallest to ``cut`` above the largest
    value (the study's ``trim = FALSE``). The bandwidth is R's default rule, 0.9 * min(sd, IQR / 1.34) * n ** -0.2; where the smaller of the two is 0 it
    takes sd, then the size of the values, then 1. ``width`` is the density over the largest density of all groups (equal areas). Groups of fewer than two values
    are left out.

    The kernel is applied to a grid, as R does: each value is shared linearly between its two nearest of ``points`` grid points, which reach
    4 bandwidths further than the outline. So a group passes the shuffle as at most ``points`` sums, however many rows it has.
    """
    g = list(keys)
    v = _clean(value)
    finite = df.select(*g, F.when(F.abs(v) < float("inf"), v).alias("v")).where("v IS NOT NULL")
    moments = finite.groupBy(*g).agg(F.stddev_samp("v").alias("sd"), F.min("v").alias("least"), F.max("v").alias("most"))
    quart = quantiles(finite, g, "v", [0.25, 0.75], ["q1", "q3"]).where("n > 1")
    shape = join_by(quart, moments, g, how="inner", null_safe=True) if g else quart.join(moments)

    def nonzero(x: Column) -> Column:
        return F.when(x != 0, x)

    spread = F.coalesce(nonzero(F.least("sd", (F.col("q3") - F.col("q1")) / 1.34)), nonzero(F.col("sd")), nonzero(F.abs("least")), F.lit(1.0))
    shape = shape.select(*g, "n", "least", "most", (adjust * 0.9 * spread * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("bw"))
    shape = small_table(shape.select(*g, "n", "bw", (F.col("least") - cut * F.col("bw")).alias("first"), (F.col("most") + cut * F.col("bw")).alias("last")))
    low, last = F.col("first") - 4 * F.col("bw"), F.lit(points - 1)
    grid = (F.col("last") - F.col("first") + 8 * F.col("bw")) / last
    placed = (join_by(finite, shape, g, how="inner", null_safe=True) if g else finite.join(shape)).withColumn("at", (F.col("v") - low) / grid)
    # a value's share of its lower and of its upper neighbour on the grid
    shares = placed.groupBy(*g, F.floor("at").cast("int").alias("bin")).agg(
        F.sum(F.floor("at") + 1 - F.col("at")).alias("lower"), F.sum(F.col("at") - F.floor("at")).alias("upper"))
    held = shares.groupBy(*g).agg(F.collect_list(F.struct("bin", "lower", "upper")).alias("bins"))  # at most ``points`` of them
    held = join_by(held, shape, g, how="inner", null_safe=True) if g else held.join(shape)
    held = held.select(*g, "n", "bw", "first", "last", "bins", grid.alias("step"))
    kernel = ("step / bw * step / bw", "exp(-0.5D * {d} * {d} * c)")
    dense = held.withColumn("grid", F.expr(f"""
        transform(sequence(0, {points - 1}), k -> transform(array({kernel[0]}), c -> aggregate(bins, 0.0D, (t, b) -> t
          + b.lower * {kernel[1].format(d="(k - b.bin)")} + b.upper * {kernel[1].format(d="(k - b.bin - 1)")}))[0] / (n * bw * {(2 * math.pi) ** 0.5!r}D))"""))
    out = dense.select(*g, "n", "bw", "first", "last", "step", "grid", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    out = out.withColumn("y", F.col("first") + F.col("point") * (F.col("last") - F.col("first")) / last)
    out = out.withColumn("at", (F.col("y") - low) / F.col("step"))
    under = F.least(F.floor("at").cast("int"), F.lit(points - 2))
    below, above = F.element_at("grid", under + 1), F.element_at("grid", under + 2)
    out = out.select(*g, "n", "bw", "point", "y", (below + (F.col("at") - under) * (above - below)).alias("density"))
    out = small_table(out).withColumn("__all", F.col("density").isNull())  # a key that is always false but no literal
    peak = out.groupBy("__all").agg(F.max("density").alias("peak"))
    return join_by(out, peak, ["__all"], how="inner").drop("__all").select(*out.drop("__all").columns, (F.col("density") / F.col("peak")).alias("width"))
