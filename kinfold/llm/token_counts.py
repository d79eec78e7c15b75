"""Token counts by offset-mapped attribution.

A document is encoded **once, whole**; its tokens' byte spans are interval-joined with the spans of its sections (or of
its fields, put together with a separator), so that counts of sections add up to the count of the document, which
encoding each section alone would not give.

A token that crosses a boundary is allocated by an explicit rule:

* ``start`` (default): to the section that holds its first byte;
* ``end``: to the section that holds its last byte;
* ``most``: to the section that holds most of its bytes (ties: the earlier one).

Sections lie end to end and cover the text, so each token goes to exactly one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .batches import slices, text_rows
from .packing import encoder

RULES = ("start", "end", "most")


def section_bounds(text: bytes, separator: bytes) -> np.ndarray:
    """Byte positions 0, ..., len(text): a section ends after each separator; nothing follows a final one."""
    cuts = [m.end() for m in re.finditer(re.escape(separator), text)]
    return np.array(sorted({0, *cuts, len(text)}), dtype=np.int64)


def attribute(sizes: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) of each section; sizes are the tokens' bytes in order, bounds the sections' ends.

    Both lists are sorted, so the join is two binary searches of one list in the other.
    """
    ends = np.cumsum(sizes)
    starts = ends - sizes
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends, side="left") - 1
    own = first if rule == "start" else last
    if rule == "most":
        own = first.copy()
        for i in np.flatnonzero(last > first).tolist():
            edges = np.concatenate([[starts[i]], bounds[first[i] + 1:last[i] + 1], [ends[i]]])
            own[i] = first[i] + int(np.diff(edges).argmax())
    n = len(bounds) - 1
    return np.bincount(own, minlength=n), np.bincount(own[last > first], minlength=n)


def section_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", separator: str = "\n", rule: str = "start", ranks: str | None = None) -> DataFrame:
    """One row for each section: id, section (from 0), start, end (bytes), n_tokens, n_crossing.

    n_crossing counts those of the section's tokens that reach over one of its ends. NULL and empty texts have the one
    section 0 with no bytes and no tokens. Ids may be NULL or repeat; an empty table gives an empty result. No shuffle:
    each text is encoded where it is read. Other columns of ``df`` are not read.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}; one of {', '.join(RULES)}")
    if not separator:
        raise ValueError("the separator is empty")
    rows = text_rows(df, id_col, text_col)
    kind = to_arrow_type(rows.schema["id"].dataType)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, mark = encoder(ranks), separator.encode()
        for ids, texts in slices(batches, as_text=True):
            own, section, start, end, tokens, crossing = [], [], [], [], [], []
            for i, text in zip(ids, texts, strict=True):
                bounds = section_bounds((text or "").encode("utf-8", "surrogatepass"), mark)
                if len(bounds) == 1:
                    bounds, n, over = np.zeros(2, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
                else:
                    n, over = attribute(encode.sizes[encode(text)], bounds, rule)
                own += [i] * len(n)
                section.append(np.arange(len(n)))
                start.append(bounds[:-1])
                end.append(bounds[1:])
                tokens.append(n)
                crossing.append(over)
            yield pa.record_batch(
                [pa.array(own, type=kind), *(pa.array(np.concatenate(c), type=t) for c, t in ((section, pa.int32()), (start, pa.int64()), (end, pa.int64()), (tokens, pa.int64()), (crossing, pa.int64())))],
                names=[id_col, "section", "start", "end", "n_tokens", "n_crossing"])

    return rows.mapInArrow(scan, f"`{id_col}` {rows.schema['id'].dataType.simpleString()}, section int, start long, end long, n_tokens long, n_crossing long")


def field_tokens(df: DataFrame, id_col: str, field_cols: list[str], separator: str = "\x1e", rule: str = "start", ranks: str | None = None) -> DataFrame:
    """One row for each row and field: id, field, n_tokens, n_crossing, of the fields put together and encoded once.

    Fields are joined by ``separator`` (its bytes belong to the field before it), which no field may hold: where one
    does, it is taken out of that field. NULL fields are empty.
    """
    text = F.concat_ws(separator, *[F.replace(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")), F.lit(separator), F.lit("")) for c in field_cols])
    # a separator at the end keeps an empty last field a section of its own
    whole = df.select(F.col(f"`{id_col}`").alias("id"), F.concat(text, F.lit(separator)).alias("text"))
    counted = section_tokens(whole, "id", "text", separator, rule, ranks)
    names = F.array(*[F.lit(c) for c in field_cols])
    return counted.select(F.col("id").alias(id_col), F.element_at(names, F.col("section") + 1).alias("field"), "n_tokens", "n_crossing")
