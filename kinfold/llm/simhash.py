"""SimHash near-duplicates by covering locality-sensitive hashing.

Every text gets a 64-bit fingerprint; fingerprints that differ in at most ``radius`` bits are linked, and the
connected components of the links are the near-duplicate groups.

**Covering masks.** Every bit position i gets a non-zero vector m(i) of radius+1 bits, dealt round robin. Table
v (each non-zero vector v) keeps the bits with odd <m(i), v>. Two fingerprints that differ in at most ``radius``
positions have at most ``radius`` vectors to avoid, and some v in a space of radius+1 dimensions is
orthogonal to all of them: in that table no differing bit is kept, so the pair collides. No pair is missed.

**Hot buckets.** Only distinct fingerprints are put in tables, so exact copies cost one entry. A bucket with more
than ``bucket_rows`` distinct fingerprints is not compared all with all: its entries are dealt anew by covering
masks over the bits that its table left out, and so on; each level fixes about four sevenths of the bits left, so a
bucket soon has few possible fingerprints. Inside a bucket every pair within the radius is found, and only the
edges of a spanning forest leave the task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import LOWER, slices, text_rows, written
from .components import components

SEED = 42


def fingerprint(text: bytes | None, shingle_words: int) -> int:
    """Unsigned 64-bit SimHash: bit set if it is set in over half of the shingles' XXH64; no words: 0."""
    words = (text or b"").translate(LOWER).split()  # bytes.split: exactly 0x20 and 0x09-0x0D
    if not words:
        return 0
    if len(words) < shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    view, digest = memoryview(line), xxhash.xxh64_intdigest
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    n = len(words) - shingle_words + 1
    starts = (ends - sizes)[:n].tolist()
    counts = np.zeros(64, dtype=np.int64)
    stops = ends[shingle_words - 1:].tolist()
    for at in range(0, n, 1 << 15):  # bounded memory for a very long text
        h = np.array([digest(view[s:e], SEED) for s, e in zip(starts[at:at + (1 << 15)], stops[at:at + (1 << 15)], strict=True)], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """(id, fp): fp as a signed long. Whole texts; NULL text counts as empty."""
    rows = text_rows(df, id_col, text_col)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            fps = np.array([fingerprint(t, shingle_words) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.record_batch([pa.array(ids, type=id_type), pa.array(fps)], names=["id", "fp"])

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(rows.schema["id"].dataType)
    return rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """One mask for each non-zero v of radius+1 bits; together they cover every pair within the radius."""
    vectors = (1 << (radius + 1)) - 1
    return [sum(1 << bit for i, bit in enumerate(bits) if bin((i % vectors + 1) & v).count("1") % 2) for v in range(1, vectors + 1)]


def mask_tree(radius: int, levels: int) -> list[list[tuple[int, int]]]:
    """Masks of each level as (parent, mask). A mask of level n holds all bits that its parent has fixed."""
    tree = [[(-1, m) for m in covering_masks(list(range(64)), radius)]]
    for _ in range(levels - 1):
        nxt = []
        for parent, (_, mask) in enumerate(tree[-1]):
            free = [i for i in range(64) if not mask >> i & 1]
            nxt += [(parent, mask | m) for m in covering_masks(free, radius)]
        tree.append(nxt)
    return tree


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def spanning_edges(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among a bucket's distinct fingerprints (every pair is compared)."""
    root = list(range(len(fps)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    edges, u = [], fps.view(np.uint64)
    step = max(1, (1 << 20) // len(fps))
    for at in range(0, len(fps), step):
        i, j = np.nonzero(np.bitwise_count(u[at:at + step, None] ^ u[None, :]) <= radius)
        above = i + at < j
        for x, y in zip((i[above] + at).tolist(), j[above].tolist(), strict=True):
            if (p := find(x)) != (q := find(y)):
                root[q] = p
                edges.append((int(fps[x]), int(fps[y])))
    return edges


def bucket_links(keyed: DataFrame, radius: int, bucket_rows: int | None) -> DataFrame:
    """Rows (t, key, fp) to spanning edges (kind 0: a, b) of each bucket, found while streaming over sorted buckets.

    A bucket beyond ``bucket_rows`` comes out as its entries (kind 1: a=fp, b=table) and is not held in memory.
    """
    dealt = keyed.repartition("t", "key").sortWithinPartitions("t", "key", "fp")

    def scan(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []  # entries of the bucket that is still open
        held_key, rows, hot = None, 0, False

        def closed(out: list) -> None:
            nonlocal held, rows, hot
            if held and not hot:
                fps = np.unique(np.concatenate(held))
                if len(fps) > 1:
                    out.extend((0, x, y) for x, y in spanning_edges(fps, radius))
            held, rows, hot = [], 0, False

        for frame in frames:
            out: list[tuple[int, int, int]] = []
            t, key, fp = (frame[c].to_numpy(dtype=np.int64) for c in ("t", "key", "fp"))
            if not len(t):
                continue
            cuts = np.concatenate([[0], np.flatnonzero((np.diff(t) != 0) | (np.diff(key) != 0)) + 1, [len(t)]])
            size = np.diff(cuts)
            for g in np.flatnonzero((size > 1) | (np.arange(len(size)) == 0) | (np.arange(len(size)) == len(size) - 1)):
                a, b = cuts[g], cuts[g + 1]
                if held_key != (t[a], key[a]):
                    closed(out)
                    held_key = (t[a], key[a])
                held.append(fp[a:b])
                rows += b - a
                if bucket_rows and (hot or rows > bucket_rows):
                    out.extend((1, int(x), int(t[a])) for part in held for x in part)
                    held, hot = [], True
            if out:
                yield pd.DataFrame(out, columns=["kind", "a", "b"])
        out = []
        closed(out)
        if out:
            yield pd.DataFrame(out, columns=["kind", "a", "b"])

    return dealt.mapInPandas(scan, "kind int, a long, b long")


def link_edges(classes: DataFrame, radius: int, bucket_rows: int = 1024, levels: int = 3) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components are those of all links within the radius."""
    tree = mask_tree(radius, levels)
    entries = classes.select("fp", F.lit(-1).cast("long").alias("parent"))
    edges = None
    for level, masks in enumerate(tree):
        children: dict[int, list[tuple[int, int]]] = {}
        for t, (parent, mask) in enumerate(masks):
            children.setdefault(parent, []).append((t, signed(mask)))
        table = F.array(*[F.struct(F.lit(p).cast("long").alias("parent"), F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.lit(m).cast("long").alias("mask")) for t, m in ms]).alias("ms")) for p, ms in sorted(children.items())])
        own = F.element_at(table, (F.col("parent") + (2 if level == 0 else 1)).cast("int"))["ms"]
        keyed = entries.select("fp", F.explode(own).alias("m")).select(
            F.col("m.t").alias("t"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"), "fp")
        last = level == len(tree) - 1
        found = written(bucket_links(keyed, radius, None if last else bucket_rows))
        part = found.where("kind = 0").select("a", "b")
        edges = part if edges is None else edges.union(part)
        if last or found.where("kind = 1").limit(1).count() == 0:
            return edges
        entries = found.where("kind = 1").select(F.col("a").alias("fp"), F.col("b").alias("parent"))
    return edges


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, radius: int = 2) -> DataFrame:
    """One row (doc_id, fingerprint, component_id, fp_copies) for each input row.

    component_id is the smallest id reachable over links of at most ``radius`` differing bits, the row's own
    included; fp_copies counts the rows with the same fingerprint. NULL and word-free texts have fingerprint
    zero and link like any other. A NULL id keeps its row and never becomes a component_id (NULL if no other id
    is reachable). Repeated rows each keep their row. An empty table gives an empty result. Other columns of
    ``df`` are not read.
    """
    docs = written(fingerprints(df, id_col, text_col, shingle_words))
    classes = written(docs.groupBy("fp").agg(F.min("id").alias("first_id"), F.count("*").alias("copies")))
    roots = components(link_edges(classes, radius)).select(F.col("node").alias("fp"), "root")
    labelled = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_class = labelled.join(firsts, "root").select("fp", "component_id", "copies")
    return docs.join(by_class, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.col("copies").alias("fp_copies"))
