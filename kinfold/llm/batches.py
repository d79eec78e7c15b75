"""Helpers shared by the operators: bounded slices of Arrow batches, byte tables, word hashes, written intermediates."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.session import materialize

#: Text bytes worked on at once in a task. A longer single text is a slice of its own.
SLICE_BYTES = 2 << 20

#: A-Z to a-z; every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A-Z to a-z, digits, a-z and all bytes from 0x80 as they are, every other byte a space.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Base (odd) of the polynomial word hash modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def text_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under private names, so no other column of ``df`` can clash."""
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def crc_bucket(id_col: Column | str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (NULL id: the empty text, so bucket 0)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % modulus


def parts(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that their second column has about ``limit`` bytes of text in each."""
    for batch in batches:
        if not len(batch):
            continue
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        group = np.concatenate([[0], np.cumsum(sizes)[:-1]]) // limit
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(sizes)]])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(int(a), int(b - a))


def slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES, as_text: bool = False) -> Iterator[tuple[list, list]]:
    """(ids, texts) lists of about ``limit`` bytes of text; texts are bytes (str if ``as_text``), None for NULL."""
    for part in parts(batches, limit):
        texts = part.column(1)
        yield part.column(0).to_pylist(), (texts if as_text else texts.cast(pa.binary())).to_pylist()


def with_columns(df: DataFrame, id_col: str, text_col: str, columns: str, names: list[str], make: Callable[[], Callable[[list], list[pa.Array]]], carry: bool) -> DataFrame:
    """``df`` with columns computed from the texts, row by row where they are read (no shuffle).

    ``make()`` runs once in a task and gives a function from a list of texts (str or None) to Arrow arrays. The result
    has the id and the new columns, or, with ``carry``, the whole input row as the struct ``row`` and the new columns, so
    that no name of the input can clash with them.
    """
    first = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row") if carry else F.col(id_col)
    rows = df.select(first, F.col(text_col).cast("string").alias("_text"))
    head = "row" if carry else id_col

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for part in parts(batches):
            yield pa.record_batch([part.column(0), *compute(part.column(1).to_pylist())], names=[head, *names])

    return rows.mapInArrow(scan, f"`{head}` {rows.schema[head].dataType.simpleString()}, {columns}")


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept for the life of the worker, grown by doubling)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each span: a polynomial modulo 2**64, the same wherever the span stands."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(values)), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(INVERSE, len(values) + 1)[starts]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer: spreads every bit of a 64-bit hash over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder; several branches then read that copy."""
    return materialize(df)
