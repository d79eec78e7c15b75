"""Approximate nearest neighbours: probed lists scanned by adaptive dimensions.

Vectors are scaled to length one, turned by a random rotation and put in lists around centres. A query scans the lists
of its nearest centres. Within a list, vectors are stored by blocks of columns. After each block a **hypothesis test**
compares the partial squared distance, scaled up to all dimensions, with the best distances found so far: after a
random rotation the first d of D dimensions are a random sample of the whole distance, so a candidate whose estimate
exceeds the bar by more than the sampling error at that d is given up, and only the others read the next columns.
What survives all columns is scored exactly, in double precision, on the original vectors.

Lists and query groups beyond a block size are dealt to several tasks, so neither a crowded list nor a popular region
is held in one task. Equal vectors: of each vector only the ``k + 1`` smallest ids can ever be answers, so the others
are left out before the shuffle (a limit within each task, then in each group), and equal queries are searched once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import written

#: Centres are fitted on this many vectors at most (the first by a hash of the vector).
SAMPLE = 20_000
MOST_LISTS = 4096
VECTORS_PER_LIST = 1024
#: Vectors of the sample whose own neighbours in the sample decide how many lists are probed.
TRIALS = 400
#: Candidates and queries in one group of the scan, on average at most.
BLOCK, QUERY_BLOCK = 8192, 2048
COLUMNS = 8
#: Width of the hypothesis test in standard errors.
WIDTH = 2.1


#: Different vector lengths of a table, at most.
MOST_LENGTHS = 1000


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): vectors of finite numbers that are not zero."""
    v = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    return rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow or underflow of the squares
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def rotation(dims: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def centres(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Spherical k-means; a centre without vectors moves to one of them."""
    rng = np.random.default_rng(seed)
    c = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        own = nearest_centres(c, sample, 1)[:, 0]
        sums = np.zeros_like(c)
        np.add.at(sums, own, sample)
        empty = ~sums.any(axis=1)
        sums[empty] = sample[rng.integers(0, len(sample), int(empty.sum()))]
        c = unit(sums)
    return c


def nearest_centres(c: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Indices of the n nearest centres of each row, nearest first."""
    out = np.empty((len(x), n), dtype=np.int64)
    for a in range(0, len(x), 1024):
        s = x[a:a + 1024] @ c.T
        part = np.argpartition(-s, n - 1, axis=1)[:, :n] if n < len(c) else np.broadcast_to(np.arange(len(c)), s.shape)
        out[a:a + 1024] = np.take_along_axis(part, np.argsort(-np.take_along_axis(s, part, axis=1), axis=1, kind="stable"), axis=1)
    return out


def probes_needed(c: np.ndarray, sample: np.ndarray, k: int, share: float) -> int:
    """Lists to probe so that they hold ``share`` of the sample's own nearest neighbours.

    Neighbours in a sample are farther than those in the whole table, so the number errs upwards.
    """
    trials = sample[:TRIALS]
    s = trials @ sample.T
    s[np.arange(len(trials)), np.arange(len(trials))] = -np.inf
    near = np.argsort(-s, axis=1, kind="stable")[:, :min(k, len(sample) - 1)]
    if not near.size:
        return 1
    rank = np.empty((len(trials), len(c)), dtype=np.int64)
    np.put_along_axis(rank, nearest_centres(c, trials, len(c)), np.arange(len(c))[None, :], axis=1)
    own = nearest_centres(c, sample, 1)[:, 0]
    return 1 + int(np.quantile(np.take_along_axis(rank, own[near], axis=1), share, method="higher"))


def scan_list(q: np.ndarray, x_blocks: list[np.ndarray], k: int, width: float) -> np.ndarray:
    """Indices of the candidates that survive every test for query ``q``; x_blocks[b] holds block b's columns, contiguous."""
    n = x_blocks[0].shape[0]
    dims = len(q)
    if n <= 4 * k:
        return np.arange(n)
    # the bar: the k-th best full distance among the vectors nearest by the first block
    first = x_blocks[0] - q[:x_blocks[0].shape[1]]
    partial = np.einsum("ij,ij->i", first, first)
    seeds = np.argpartition(partial, 4 * k - 1)[:4 * k]
    full, at = partial[seeds].copy(), x_blocks[0].shape[1]
    for b in x_blocks[1:]:
        diff = b[seeds] - q[at:at + b.shape[1]]
        full += np.einsum("ij,ij->i", diff, diff)
        at += b.shape[1]
    bar = np.partition(full, k - 1)[k - 1]
    alive, at = np.arange(n), x_blocks[0].shape[1]
    for b in x_blocks[1:]:
        keep = partial * (dims / at) <= bar * (1.0 + width / np.sqrt(at)) ** 2
        keep[np.searchsorted(alive, np.sort(seeds[np.isin(seeds, alive)]))] = True
        alive, partial = alive[keep], partial[keep]
        diff = b[alive] - q[at:at + b.shape[1]]
        partial = partial + np.einsum("ij,ij->i", diff, diff)
        at += b.shape[1]
    return alive[partial <= np.partition(partial, k - 1)[k - 1] * (1 + 1e-9) + 1e-12] if len(alive) > k else alive


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of original vectors in double precision."""
    qs, xs = np.abs(q).max(), np.abs(x).max(axis=1)
    q, x = q / qs, x / xs[:, None]
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def nearest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5, share: float = 0.97, width: float = WIDTH) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, its ``k`` nearest found others.

    As many lists are probed as hold ``share`` of the nearest neighbours in a bounded sample. Nearness is the cosine; ties go to the smaller id. Vectors that are NULL, zero, or
    that hold NULL or non-finite numbers take no part, nor do rows without an id. Vectors of different lengths have no cosine: each length is
    searched by itself (``MOST_LENGTHS`` of them at most). Fewer than ``k`` other vectors: all
    of them. Rows that repeat an id with the same vector count once; an id with different vectors keeps each. An empty
    table gives an empty result. Other columns of ``df`` are not read.
    """
    rows = usable(df, id_col, vector_col)
    lengths = [r["d"] for r in rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(MOST_LENGTHS + 1).collect()]
    if len(lengths) > MOST_LENGTHS:
        raise ValueError(f"{vector_col} has vectors of more than {MOST_LENGTHS} lengths")
    found = [nearest_of_length(rows.where(F.size("v") == d) if len(lengths) > 1 else rows, every, k, share, width) for d in lengths]
    return reduce(DataFrame.union, found) if found else df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def nearest_of_length(rows: DataFrame, every: int, k: int, share: float, width: float) -> DataFrame:
    """``nearest`` of vectors (vec_id, v) of one length."""
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = rows.distinct()
    firsts = Window.partitionBy("v").orderBy("vec_id")
    pool = written(rows.withColumn("nth", F.row_number().over(firsts)).where(F.col("nth") <= k + 1).select("vec_id", "v"))
    total = pool.count()
    if not total:
        return spark.createDataFrame([], schema)
    chosen = pool.orderBy(F.xxhash64("v"), "vec_id").limit(SAMPLE).select("v").collect()
    sample = unit(np.array([r["v"] for r in chosen], dtype=np.float64))
    dims = sample.shape[1]
    turn = rotation(dims)
    c = centres(sample, max(1, min(MOST_LISTS, total // VECTORS_PER_LIST, len(sample))))
    probes = probes_needed(c, sample, k, share)
    shared = spark.sparkContext.broadcast((c, turn))

    def assign(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, _ = shared.value
        for f in frames:
            if len(f):
                yield f.assign(list=nearest_centres(own, unit(np.array(f["v"].tolist(), dtype=np.float64)), 1)[:, 0])

    listed = written(pool.mapInPandas(assign, "vec_id long, v array<double>, list long"))
    sizes = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}  # a number for each centre
    filled = np.array([sizes.get(i, 0) for i in range(len(c))])

    queries = rows.where(F.col("vec_id") % every == 0)
    points = queries.groupBy("v").agg(F.min("vec_id").alias("qid"))  # equal queries are searched once

    def probe(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, _ = shared.value
        for f in frames:
            if not len(f):
                continue
            order = nearest_centres(own, unit(np.array(f["v"].tolist(), dtype=np.float64)), len(own))
            there = np.cumsum(filled[order], axis=1)
            # as many lists as asked for, and more until they hold enough vectors
            n = np.maximum(probes, 1 + (there < min(10 * (k + 1), int(filled.sum()))).sum(axis=1))
            wanted = (np.arange(len(own))[None, :] < n[:, None]) & (filled[order] > 0)
            at, nth = np.nonzero(wanted)
            yield pd.DataFrame({"qid": f["qid"].to_numpy()[at], "qv": [f["v"].iloc[i] for i in at], "list": order[at, nth]})

    probing = written(points.select("qid", "v").mapInPandas(probe, "qid long, qv array<double>, list long"))
    asked = {r["list"]: r["count"] for r in probing.groupBy("list").count().collect()}
    splits = spark.createDataFrame([(int(i), int(-(-sizes[i] // BLOCK)), int(-(-n // QUERY_BLOCK))) for i, n in asked.items()], "list long, parts int, query_parts int")
    splits = F.broadcast(splits)  # a row for each centre at most
    left = listed.join(splits, "list").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts"))).withColumn(
        "query_part", F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1))).select("list", "part", F.col("query_part").cast("long").alias("query_part"), "vec_id", "v")
    right = probing.join(splits, "list").withColumn("query_part", F.pmod(F.xxhash64("qid"), F.col("query_parts"))).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("list", F.col("part").cast("long").alias("part"), "query_part", "qid", "qv")

    def scan(candidates: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out_q, out_v, out_s = [], [], []
        if len(candidates) and len(asking):
            ids, x = candidates["vec_id"].to_numpy(), np.array(candidates["v"].tolist(), dtype=np.float64)
            turned = unit(x) @ shared.value[1]
            blocks = [np.ascontiguousarray(turned[:, a:a + COLUMNS]) for a in range(0, dims, COLUMNS)]
            qx = np.array(asking["qv"].tolist(), dtype=np.float64)
            for qid, original, q in zip(asking["qid"], qx, unit(qx) @ shared.value[1], strict=True):
                alive = scan_list(q, blocks, k + 1, width)
                s = exact_scores(original, x[alive])
                best = np.lexsort((ids[alive], -s))[:k + 1]
                out_q += [qid] * len(best)
                out_v += ids[alive[best]].tolist()
                out_s += s[best].tolist()
        return pd.DataFrame({"qid": out_q, "vec_id": out_v, "score": out_s})

    keys = ["list", "part", "query_part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(scan, "qid long, vec_id long, score double")
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("top"))  # k + 1 at most
    answers = queries.join(points.withColumnRenamed("v", "pv"), F.col("v") == F.col("pv")).select(F.col("vec_id").alias("query_id"), "qid").join(top, "qid")
    others = F.slice(F.filter("top", lambda t: t["vec_id"] != F.col("query_id")), 1, k)
    return answers.select("query_id", F.posexplode(others).alias("at", "t")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), F.col("t.score").alias("score"))
