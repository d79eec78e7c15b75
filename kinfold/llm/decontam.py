"""Benchmark decontamination: a prefix-filtered set join of benchmark windows with documents.

A window is ``window_words`` consecutive words of an item (an item of fewer words, but not none, is one window).
A document holds a window only if it holds every word of it, so it is enough to look for the window's
**prefix**: its rarest word over all documents (ties by the word itself). The steps:

1. count, over all documents, the words that benchmark items use, and order each window's words by rarity;
2. scan the documents: a word that is some window's prefix proposes the window starts that its place in that
   window allows (**positional bound**) and that leave room for the window in the text (**length bound**);
   a proposal whose words hash to no window is dropped;
3. join the proposals with the windows on the whole window text, which **verifies exact containment**, and merge
   the hit spans of each document.

What is broadcast are three bit tables with ``BITS_EACH`` bits for each window of the benchmark, from ``LEAST_BITS`` to ``MOST_BITS``: at most 16 MB
each, whatever the size of either input. A bit that is set by chance only sends a proposal that step 3 rejects, so the tables never change the
result; beyond the most bits there are more such proposals.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .batches import ALNUM, BASE, INVERSE, mixed, powers, slices, span_hashes, text_rows, written

LEAST_BITS, MOST_BITS, BITS_EACH = 1 << 22, 1 << 27, 16
#: Text bytes scanned at once: the arrays of hashes are some dozen times as large.
SCAN_BYTES = 1 << 19
#: Copies of the window side in the verifying join: a passage that very many documents hold is dealt to so many tasks; so is a word
#: that very many items hold in the join with its count.
SALTS = 16


def word_spans(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a buffer in which every separator is a space."""
    inside = np.zeros(len(buffer) + 2, dtype=np.int8)
    inside[1:-1] = buffer != 32
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def gram_hashes(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` word hashes from each start (the same wherever they stand), mixed with the length."""
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers(BASE, len(words)), out=sums[1:])
    return mixed((sums[starts + length] - sums[starts]) * powers(INVERSE, len(words) + 1)[starts] + np.uint64(length))


def table_bits(entries: int) -> int:
    """Bits of a table of so many entries: a power of two."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * entries).bit_length()))


def has_bit(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the hashes' bits are set in a packed table."""
    slots = slot(h, 8 * len(table))
    return (table[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 1


def slot(h: np.ndarray, bits: int) -> np.ndarray:
    return (h & np.uint64(bits - 1)).astype(np.int64)


def joined_text(texts: list) -> tuple[np.ndarray, bytes, np.ndarray]:
    """All texts of a slice as one byte table-translated buffer, each ended by a space; and where each begins."""
    parts = [(t or b"").translate(ALNUM) for t in texts]
    begins = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])]).astype(np.int64)
    whole = b" ".join(parts) + b" "
    return np.frombuffer(whole, dtype=np.uint8), whole, begins


def item_words(df: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, words): words as an array; items without words are left out."""
    rows = text_rows(df, item_col, text_col)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            words = [[w.decode("utf-8", "surrogateescape") for w in (t or b"").translate(ALNUM).split()] for t in texts]
            keep = [i for i, w in enumerate(words) if w]
            yield pa.record_batch([pa.array([ids[i] for i in keep], type=kind), pa.array([words[i] for i in keep], type=pa.list_(pa.string()))], names=["item", "words"])

    kind = to_arrow_type(rows.schema["id"].dataType)
    return rows.mapInArrow(scan, f"item {rows.schema['id'].dataType.simpleString()}, words array<string>")


def word_hash_of(words: list[str]) -> np.ndarray:
    """Hashes of single words, equal to those that a scan finds in a text."""
    raw = [w.encode("utf-8", "surrogateescape") for w in words]
    buffer = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    return mixed(span_hashes(buffer, *word_spans(buffer)))


def bit_table(df: DataFrame, columns: list[str], to_hashes, bits: int) -> np.ndarray:
    """Packed table with the bits of the hashes that ``to_hashes`` gives for the rows; at most ``bits`` integers reach the driver."""
    def scan(frames):
        import pandas as pd
        for frame in frames:
            yield pd.DataFrame({"slot": np.unique(slot(to_hashes(frame), bits)) if len(frame) else np.zeros(0, dtype=np.int64)})

    found = df.select(*columns).mapInPandas(scan, "slot long").distinct().toPandas()["slot"]
    table = np.zeros(bits, dtype=bool)
    table[found.to_numpy(dtype=np.int64)] = True
    return np.packbits(table)


def count_words(documents: DataFrame, id_col: str, text_col: str, vocabulary: np.ndarray) -> DataFrame:
    """(word, n) over all documents for every word whose bit is set in ``vocabulary``."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for ids, texts in slices(batches, SCAN_BYTES):
            buffer, whole, _ = joined_text(texts)
            starts, ends = word_spans(buffer)
            h = mixed(span_hashes(buffer, starts, ends))
            known = np.flatnonzero(has_bit(shared.value, h))
            _, first, n = np.unique(h[known], return_index=True, return_counts=True)
            for i, k in zip(known[first].tolist(), n.tolist(), strict=True):
                w = whole[starts[i]:ends[i]]
                seen[w] = seen.get(w, 0) + k
            if len(seen) > 200_000:  # bounded memory: the sums are added up after the shuffle
                yield packed(seen)
                seen = {}
        if seen:
            yield packed(seen)

    def packed(seen: dict[bytes, int]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([w.decode("utf-8", "surrogateescape") for w in seen], type=pa.string()), pa.array(list(seen.values()), type=pa.int64())], names=["word", "n"])

    return text_rows(documents, id_col, text_col).mapInArrow(scan, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def benchmark_windows(items: DataFrame, counts: DataFrame, window_words: int) -> DataFrame:
    """(item, window, length, prefix, place): each distinct window of each item with its rarest word and that word's place.

    The counts are joined with the words of the items, which are dealt over ``SALTS`` copies of the counts, and go back to their item as a list
    beside its words: windows read them there.
    """
    words = items.select("row", F.posexplode("words").alias("at", "word")).withColumn("salt", F.pmod(F.xxhash64("row", "at"), F.lit(SALTS)).cast("int"))
    copies = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = words.join(copies, ["word", "salt"], "left").groupBy("row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n")))), lambda x: x["n"]).alias("counts"))
    length = F.least(F.size("words"), F.lit(window_words))
    each = items.join(known, "row").select("item", "words", "counts")
    begins = F.sequence(F.lit(1), F.size("words") - length + 1)
    windows = each.select("item", F.explode(F.transform(begins, lambda i: F.struct(
        F.slice("words", i, length).alias("w"), F.slice("counts", i, length).alias("c")))).alias("x")).select("item", "x.w", "x.c")
    least = F.array_min(F.transform("w", lambda w, i: F.struct(F.element_at("c", i + 1).alias("n"), w.alias("word"), i.alias("place"))))
    windows = windows.select("item", F.array_join("w", " ").alias("window"), F.size("w").alias("length"), least.alias("least"))
    return windows.dropDuplicates(["item", "window"]).select("item", "window", "length", F.col("least.word").alias("prefix"), F.col("least.place").alias("place"))


def proposals(documents: DataFrame, id_col: str, text_col: str, tables: dict, lengths: list[int]) -> DataFrame:
    """A row (id, row, n_words, NULL...) for each document, and one for each proposed window (id, row, window, start, length).

    ``row`` is a hash of the text: rows of one id with different texts stay apart, repeated rows fall together.
    """
    rows = text_rows(documents, id_col, text_col)
    shared = rows.sparkSession.sparkContext.broadcast((tables, lengths))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        bits, sizes = shared.value
        for ids, texts in slices(batches, SCAN_BYTES):
            buffer, whole, begins = joined_text(texts)
            starts, ends = word_spans(buffer)
            doc = np.searchsorted(begins, starts, side="right") - 1
            first = np.searchsorted(starts, begins)  # the first word of each text
            h = mixed(span_hashes(buffer, starts, ends))
            n_words = np.diff(first)
            key = [xxhash.xxh64_intdigest(t or b"") - (1 << 63) for t in texts]
            out = {"id": list(ids), "row": list(key), "n_words": n_words.tolist(), "window": [None] * len(ids), "start": [0] * len(ids), "length": [0] * len(ids)}
            prefix = np.flatnonzero(has_bit(bits["prefix"], h))
            for length in sizes if len(prefix) else []:
                for place in range(length):
                    at = prefix - place
                    ok = (at >= first[doc[prefix]]) & (at + length <= first[doc[prefix] + 1])
                    ok[ok] = has_bit(bits["place"], mixed(h[prefix[ok]] + np.uint64(place * 65537 + length)))
                    at = at[ok]
                    at = at[has_bit(bits["window"], gram_hashes(h, at, length))] if len(at) else at
                    for i in at.tolist():
                        d = int(doc[i])
                        out["id"].append(ids[d])
                        out["row"].append(key[d])
                        out["n_words"].append(None)
                        out["window"].append(b" ".join(whole[starts[i]:ends[i + length - 1]].split()).decode("utf-8", "surrogateescape"))
                        out["start"].append(i - int(first[d]))
                        out["length"].append(length)
            yield pa.record_batch([pa.array(out["id"], type=kind), pa.array(out["row"], type=pa.int64()), pa.array(out["n_words"], type=pa.int64()), pa.array(out["window"], type=pa.string()), pa.array(out["start"], type=pa.int32()), pa.array(out["length"], type=pa.int32())], names=["id", "row", "n_words", "window", "start", "length"])

    kind = to_arrow_type(rows.schema["id"].dataType)
    return rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, row long, n_words long, window string, start int, length int")


def decontaminate(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window_words: int = 13, one_in: int = 20) -> DataFrame:
    """One row for each document: n_words, n_hit, n_items, items (sorted as text), contaminated, hit_spans.

    A word is hit if it stands inside any occurrence of any benchmark window; a document is contaminated if it
    has hit words and they are at least one in ``one_in`` of its words. Words are runs of ASCII letters (lower-cased),
    digits and characters beyond ASCII. NULL and word-free texts have no words and are clean; items without
    words have no windows; a NULL item id is the empty text. A repeated row (same id, same text) gives one row; one id with different texts gives a
    row for each text; a NULL id is an id of its own. An empty benchmark leaves every document clean. Other
    columns of either table are not read.
    """
    items = written(item_words(benchmark, item_col, item_text_col).withColumn("row", F.monotonically_increasing_id()))
    used = written(items.select(F.explode("words").alias("word")).distinct())
    vocabulary = bit_table(used, ["word"], lambda f: word_hash_of(f["word"].tolist()), table_bits(used.count()))
    windows = written(benchmark_windows(items, count_words(documents, id_col, text_col, vocabulary), window_words))
    bits = table_bits(windows.count())

    def place_hashes(f):
        return mixed(word_hash_of(f["prefix"].tolist()) + (f["place"].to_numpy(dtype=np.uint64) * np.uint64(65537) + f["length"].to_numpy(dtype=np.uint64)))

    def window_hashes(f):
        return np.array([gram_hashes(word_hash_of(w.split(" ")), np.array([0]), n)[0] for w, n in zip(f["window"], f["length"], strict=True)], dtype=np.uint64)

    tables = {
        "prefix": bit_table(windows, ["prefix"], lambda f: word_hash_of(f["prefix"].tolist()), bits),
        "place": bit_table(windows, ["prefix", "place", "length"], place_hashes, bits),
        "window": bit_table(windows, ["window", "length"], window_hashes, bits),
    }
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most window_words values
    by_text = windows.groupBy("window").agg(F.collect_set(F.coalesce(F.col("item").cast("string"), F.lit(""))).alias("items"))
    salted = by_text.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = proposals(documents, id_col, text_col, tables, lengths)
    # a document's own row has no window; an own text as its key keeps such rows apart from each other
    found = found.withColumn("salt", F.pmod(F.xxhash64("id", "row"), F.lit(SALTS)).cast("int")).withColumn(
        "probe", F.coalesce("window", F.concat(F.lit(" "), F.xxhash64("id", "row").cast("string"))))
    joined = found.join(salted.withColumnRenamed("window", "probe"), ["probe", "salt"], "left")
    hits = joined.groupBy("id", "row").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("items").isNotNull(), F.struct("start", (F.col("start") + F.col("length")).alias("end"))))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    merged = F.aggregate(
        "spans", F.expr("cast(array() as array<struct<start:int,end:int>>)"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))))
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    hits = hits.withColumn("hit_spans", F.when(F.size("spans") == 0, F.expr("cast(array() as array<struct<start:int,end:int>>)")).otherwise(merged))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda acc, s: acc + (s["end"] - s["start"]).cast("long"))
    return hits.withColumn("n_hit", n_hit).select(
        F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        ((F.col("n_hit") > 0) & (F.lit(one_in) * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "hit_spans")
