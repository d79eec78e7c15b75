"""Whitening of embedding vectors (operator 11) by bit-sliced scatter.

An entry c becomes the integer x = floor(1024 * c) + 100000. The scatter of the x-vectors is counted exactly: each dimension is
shifted to start at 0, the bits of its values are sliced into planes, and a plane is packed across rows into 64-bit words. The
product sum of two dimensions is then the sum over their planes a and b of 2**(a + b) times the population count of the planes' AND. Tasks
add such counts up in integers and give one row for each pair of dimensions; Spark adds the tasks' rows. Centring is done in integers as well
(n * products - sums * sums, which is n**2 times the covariance), so nothing is rounded before the eigenvectors are computed.

The eigenvectors come from ``eigh`` in double precision and are then turned further by Jacobi rotations in extended
precision, so that small components next to large ones are right too. Vectors are read three times (bounds and sums, products, projection); what
reaches the driver is the number of pairs of dimensions, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import written

# Scale and shift of an entry.
SCALE, SHIFT = 1024, 100000

#: Rows whose planes are held at once in a task.
BLOCK_ROWS = 1 << 14
#: Pairs of dimensions, over all vector lengths, that may pass through the driver.
MOST_PAIRS = 1 << 25
#: An eigenvalue of at most this share of their sum is no variance.
NO_VARIANCE = 1e-16
#: Low part of a count: sums of parts stay below the 38 digits of a decimal.
LOW_BITS = 62


def integer_rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): the usable vectors as integers; rows whose vector is NULL or holds a NULL or non-finite entry are left out."""
    v = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    usable = F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    fits = F.forall("v", lambda c: F.abs(c) < float(1 << 50))
    x = F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))) + F.lit(SHIFT))
    checked = F.when(fits, x).otherwise(F.raise_error(F.lit(f"an entry of {vector_col} is beyond 2**50 and has no long value")).cast("array<bigint>"))
    return v.where(usable).where(F.size("v") > 0).select("id", checked.alias("x"))


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, int, np.ndarray]]:
    """(ids, length, matrix of the vectors) for each length in each batch."""
    for batch in batches:
        lists = batch.column(1)
        sizes = np.diff(lists.offsets.to_numpy())
        for d in np.unique(sizes):
            at = pa.array(np.flatnonzero(sizes == d))
            yield batch.column(0).take(at), int(d), lists.take(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, int(d))


def bounds(rows: DataFrame) -> dict[int, tuple[int, list[int], list[int], list[int]]]:
    """Vector length -> (rows, and for each dimension its sum, least and largest value)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for _, d, x in matrices(batches):
            lo, hi = x.min(axis=0), x.max(axis=0)
            total = [int(a) * len(x) + int(b) for a, b in zip(lo.tolist(), _exact_sums(x - lo), strict=True)]
            n, s, least, most = found.get(d, (0, [0] * d, lo, hi))
            found[d] = [n + len(x), [a + b for a, b in zip(s, total, strict=True)], np.minimum(least, lo), np.maximum(most, hi)]
        for d, (n, s, lo, hi) in found.items():
            yield pa.record_batch([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                                   pa.array(map(Decimal, s), pa.decimal128(38, 0)), pa.array(lo), pa.array(hi)], names=["d", "j", "n", "s", "lo", "hi"])

    parts = rows.mapInArrow(scan, "d int, j int, n long, s decimal(38,0), lo long, hi long")
    out: dict[int, tuple] = {}
    for r in parts.groupBy("d", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("d", "j").collect():
        n, s, lo, hi = out.setdefault(r.d, (r.n, [], [], []))
        s.append(int(r.s))
        lo.append(r.lo)
        hi.append(r.hi)
    return out


def _exact_sums(y: np.ndarray) -> list[int]:
    """Sum of each column of non-negative integers, without overflow."""
    low, high = y & 0xFFFFFFFF, y >> 32
    return [int(a) + (int(b) << 32) for a, b in zip(low.sum(axis=0).tolist(), high.sum(axis=0).tolist(), strict=True)]


def planes_of(y: np.ndarray, widths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(planes, dimension of each, bit of each): the bits of the columns of ``y``, packed across rows into words.

    A dimension has as many planes as its ``width`` in bits; one of width 0 has none.
    """
    dims = np.repeat(np.arange(len(widths)), widths)
    bits = np.concatenate([np.arange(w) for w in widths]) if len(dims) else dims
    padded = np.zeros((-len(y) % 64 + len(y), y.shape[1]), dtype=np.int64)
    padded[:len(y)] = y
    columns = np.ascontiguousarray(padded.T)
    planes = np.empty((len(dims), len(padded) // 64), dtype=np.uint64)
    for k, (j, b) in enumerate(zip(dims.tolist(), bits.tolist(), strict=True)):
        planes[k] = np.packbits((columns[j] >> b) & 1 > 0).view(np.uint64)
    return planes, dims, bits


def scatter(y: np.ndarray, widths: list[int]) -> np.ndarray:
    """Upper half of the product sums of the columns of ``y`` (integers of any size), by weighted AND-popcounts."""
    d = len(widths)
    out = np.zeros((d, d), dtype=object)
    planes, dims, bits = planes_of(y, widths)
    small = 2 * max(widths, default=0) + len(y).bit_length() < 63
    weights = np.array([1 << int(b) for b in bits], dtype=np.int64 if small else object)
    begins = np.concatenate([[0], np.flatnonzero(np.diff(dims)) + 1]) if len(dims) else dims
    owners = dims[begins]
    for k in range(len(planes)):
        first = begins[np.searchsorted(begins, k, side="right") - 1]  # from the first plane of the same dimension on
        counts = np.bitwise_count(planes[k] & planes[first:]).sum(axis=1, dtype=np.int64)
        at = begins[begins >= first]
        sums = np.add.reduceat(counts * weights[first:], at - first)
        out[dims[k], owners[begins >= first]] += sums.astype(object) * (1 << int(bits[k]))
    return out


def products(rows: DataFrame, known: dict[int, tuple]) -> dict[int, np.ndarray]:
    """Vector length -> exact product sums of the shifted dimensions (upper half), of all rows."""
    shifts = {d: (np.array(lo, dtype=np.int64), [(b - a).bit_length() for a, b in zip(lo, hi, strict=True)]) for d, (_, _, lo, hi) in known.items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        total: dict[int, np.ndarray] = {}

        def count(d: int) -> None:
            lo, widths = shifts[d]
            part = scatter(np.concatenate(held.pop(d)) - lo, widths)
            total[d] = total[d] + part if d in total else part

        for _, d, x in matrices(batches):
            for at in range(0, len(x), BLOCK_ROWS):
                held.setdefault(d, []).append(x[at:at + BLOCK_ROWS])
                if sum(map(len, held[d])) >= BLOCK_ROWS:
                    count(d)
        for d in list(held):
            count(d)
        low = (1 << LOW_BITS) - 1
        for d, sums in total.items():
            i, j = np.triu_indices(d)
            for at in range(0, len(i), 1 << 16):
                a, b = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
                values = [int(v) for v in sums[a, b]]
                yield pa.record_batch([pa.array(np.full(len(a), d), pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                                       pa.array([Decimal(v >> LOW_BITS) for v in values], pa.decimal128(38, 0)),
                                       pa.array([Decimal(v & low) for v in values], pa.decimal128(38, 0))], names=["d", "i", "j", "high", "low"])

    found = rows.mapInArrow(scan, "d int, i int, j int, high decimal(38,0), low decimal(38,0)")
    out = {d: np.zeros((d, d), dtype=object) for d in known}
    for r in found.groupBy("d", "i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).toLocalIterator():
        out[r.d][r.i, r.j] = (int(r.high) << LOW_BITS) + int(r.low)
    return out


def extended(value: int) -> np.longdouble:
    """An integer of any size in extended precision."""
    first = float(value)
    return np.longdouble(first) + np.longdouble(float(value - int(first)))


def principal(scaled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues from the largest down, eigenvectors as columns) of a symmetric matrix in extended precision."""
    d = len(scaled)
    size = np.abs(scaled).max() if d else 0
    if not size:
        return np.zeros(d, dtype=np.longdouble), np.eye(d, dtype=np.longdouble)
    a = scaled / size
    q = np.linalg.eigh(a.astype(np.float64))[1][:, ::-1].astype(np.longdouble)
    for k in range(d):  # orthonormal to extended precision; twice is enough
        for _ in range(2):
            q[:, k] -= q[:, :k] @ (q[:, :k].T @ q[:, k])
        q[:, k] /= np.sqrt(q[:, k] @ q[:, k])
    b = q.T @ a @ q
    eps = np.finfo(np.longdouble).eps
    for _ in range(30):
        off = np.abs(b)
        scale = np.sqrt(np.abs(np.outer(b.diagonal(), b.diagonal())))
        pairs = np.argwhere(np.triu(off > np.maximum(eps * scale, eps * eps), 1))
        if not len(pairs):
            break
        for i, j in pairs.tolist():
            if abs(b[i, j]) <= max(eps * np.sqrt(abs(b[i, i] * b[j, j])), eps * eps):
                continue
            theta = (b[j, j] - b[i, i]) / (2 * b[i, j])
            t = (1 if theta >= 0 else -1) / (abs(theta) + np.sqrt(theta * theta + 1))
            c = 1 / np.sqrt(t * t + 1)
            turn = np.array([[c, t * c], [-t * c, c]], dtype=np.longdouble)
            b[:, [i, j]] = b[:, [i, j]] @ turn
            b[[i, j], :] = turn.T @ b[[i, j], :]
            q[:, [i, j]] = q[:, [i, j]] @ turn
    order = np.argsort(-b.diagonal(), kind="stable")
    q = q[:, order]
    return b.diagonal()[order] * size, q * np.where(q[np.abs(q).argmax(axis=0), np.arange(d)] < 0, -1, 1)


def covariance_parts(n: int, sums: list[int], lo: list[int], product: np.ndarray) -> np.ndarray:
    """n**2 times the covariance: integers, centred before anything is rounded; then in extended precision."""
    d = len(sums)
    shifted = [s - n * a for s, a in zip(sums, lo, strict=True)]
    out = np.zeros((d, d), dtype=np.longdouble)
    for i in range(d):
        for j in range(i, d):
            out[i, j] = out[j, i] = extended(n * int(product[i, j]) - shifted[i] * shifted[j])
    return out


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """Whitened coordinates of every usable vector on the first ``components`` principal components, a row for each of them.

    Result: the id, component (from 1, by falling eigenvalue), n (vectors of the fit list), deviation (sum over dimensions of
    (n * x - S)**2, exact; NULL where that is no long), whitened, explained (share of the component in the whole variance) and identity_error (largest
    absolute entry of the whitened covariance minus the identity, measured on the result).

    The fit list is all usable vectors. A vector that is NULL or holds a NULL or non-finite entry is no row of the result, nor is an empty one; an
    entry beyond 2**50 is an error. Vectors of different lengths cannot share a covariance: each length is a fit list of its own. Components
    without variance (a single vector, equal vectors, fewer vectors than components) have no rows. Repeated vectors and repeated or
    NULL ids count as often as they stand. An empty table gives an empty result. Other columns of ``df`` are not read.
    """
    rows = integer_rows(df, id_col, vector_col)
    known = bounds(rows)
    if (pairs := sum(d * (d + 1) // 2 for d in known)) > MOST_PAIRS:
        raise ValueError(f"the vectors have {pairs} pairs of dimensions, more than {MOST_PAIRS}")
    crossed = products(rows, known) if known else {}
    models = {}
    for d, (n, sums, lo, hi) in known.items():
        values, vectors = principal(covariance_parts(n, sums, lo, crossed[d]))
        whole = values.sum()
        k = min(components, int((values > whole * NO_VARIANCE).sum())) if whole > 0 else 0
        # of n**2 times the covariance: the coordinates of n * x - S over the root of its eigenvalue
        axes = (vectors[:, :k] / np.sqrt(values[:k])).astype(np.float64)
        bound = n * max((b - a for a, b in zip(lo, hi, strict=True)), default=0)
        models[d] = (n, np.array(sums, dtype=object), axes, bound, [float(v / whole) for v in values[:k]])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, d, x in matrices(batches):
            n, sums, axes, bound, _ = models[d]
            if max(abs(int(s)) for s in sums) < 1 << 62 and bound < 1 << 62 and n * int(np.abs(x).max()) < 1 << 62:
                u = n * x - sums.astype(np.int64)
            else:
                u = n * x.astype(object) - sums
            if u.dtype == object or d * bound * bound >= 1 << 63:
                deviation = [v if v < 1 << 63 else None for v in (u.astype(object) ** 2).sum(axis=1).tolist()]
            else:
                deviation = (u * u).sum(axis=1)
            w = u.astype(np.float64) @ axes
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, axes.shape[1] or 1)[:len(w) + 1] if axes.shape[1] else np.zeros(len(w) + 1), pa.int32()), pa.array(w.reshape(-1)))
            yield pa.record_batch([ids, pa.array(np.full(len(x), d), pa.int32()), pa.array(deviation, pa.int64()), flat], names=["id", "d", "deviation", "w"])

    kind = rows.schema["id"].dataType.simpleString()
    done = written(rows.mapInArrow(project, f"id {kind}, d int, deviation long, w array<double>"))
    error = F.greatest(*[F.abs(F.coalesce(F.covar_pop(F.try_element_at("w", F.lit(i + 1)), F.try_element_at("w", F.lit(j + 1))), F.lit(1.0 if i == j else 0.0)) - (1.0 if i == j else 0.0))
                         for i in range(components) for j in range(i, components)], F.lit(0.0))
    measured = {r.d: r.error for r in done.groupBy("d").agg(error.alias("error")).collect()}
    facts = [(d, n, shares, measured[d]) for d, (n, _, _, _, shares) in models.items()]
    facts = F.broadcast(df.sparkSession.createDataFrame(facts, "d int, n long, shares array<double>, identity_error double"))  # a row for each length
    out = done.join(facts, "d").select("*", F.posexplode("w").alias("at", "whitened"))
    return out.select(F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
                      F.element_at("shares", F.col("at") + 1).alias("explained"), "identity_error")
