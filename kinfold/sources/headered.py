"""CSV with a header row, read by column name, from files or from texts.

Spark's CSV reader takes columns by position when it is given a schema, and the header of the first file for all files
when it is not. Exported files may order their columns differently. Two ways around that:

* ``read_by_header``: files of a folder. One job finds the header of each file; the files that share one are then read by
  Spark's own CSV scan, with that header's positions, only the wanted columns parsed, and rows streamed. The scans are
  united. No file is held as one row.
* ``csv_rows``: texts in a column (a listing already read, a stream, a table of responses), each with its own header. A text is
  cut into fields once, by one pattern that knows quotes, so a record ends at a line break outside quotes.

In both, a quote counts where it begins a field; two quotes inside a quoted field are one; blanks around a field, blank lines and a byte order
mark are dropped; an empty field and NA are NULL (as the study's reader takes them).
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One field with the comma or line break that ends it. A quote that never closes is an ordinary character.
FIELD = '\\G(?:[ \\t]*+"[^"]*+(?:""[^"]*+)*+"[^,\\n]*+|[^,\\n]*+)[,\\n]'
#: Texts that stand for a missing value.
MISSING = ("", "NA")


def plain_path(column: str) -> Column:
    """A path or name of file metadata as a listing shows it (the reader's own is URI-encoded)."""
    return F.url_decode(F.regexp_replace(F.col(column), "\\+", "%2B"))


def text_files(spark: SparkSession, path: str, glob: str | None = None, stream: bool = False, **options) -> DataFrame | None:
    """(path, file_name, text), a row for each file; None when the folder or file does not exist.

    Names come from file metadata, so a filter on them is applied before a file is opened.
    """
    reader = (spark.readStream if stream else spark.read).format("text").option("wholetext", True).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        return reader.load(path).select(plain_path("_metadata.file_path").alias("path"), plain_path("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))
    except AnalysisException:
        return None


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _unquoted(field: Column) -> Column:
    """Text of a field cut by ``FIELD``: without its end, blanks and quotes; NULL if missing."""
    def inner(x: Column) -> Column:
        quoted = x.startswith('"') & x.endswith('"') & (F.length(x) >= 2)
        plain = F.when(quoted, F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x)
        return F.when(~plain.isin(*MISSING), plain)
    return _let(F.regexp_replace(field, "^[ \\t]+|[ \\t]*[,\\n]$", ""), inner)


def csv_rows(files: DataFrame, columns: dict[str, str], text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """The records of each text: ``keep`` columns of ``files``, then ``columns`` ({name in header: type}).

    Columns are found by their name in the text's own header (letter case and surrounding blanks do not count), in any order and
    among any number of others; values that do not fit the type are NULL. A text without one of the columns is an error if it has
    records. Blank lines, empty texts and NULL texts give no rows; a record with fewer fields has NULLs at its end.
    """
    def records(fields: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(1), F.size(fields)), lambda i: F.element_at(fields, i).endswith("\n"))
        return _let(ends, lambda stops: spans_of(fields, stops))

    def spans_of(fields: Column, stops: Column) -> Column:
        spans = F.transform(stops, lambda last, k: F.struct(F.when(k == 0, F.lit(0)).otherwise(F.try_element_at(stops, k)).alias("before"), last.alias("last")))
        filled = F.filter(spans, lambda s: (s["last"] - s["before"] > 1) | (F.trim(F.regexp_replace(F.element_at(fields, s["last"]), "[\\t\\n]", "")) != ""))
        return _let(filled, lambda kept: F.when(F.size(kept) > 1, values_of(fields, kept)))

    def values_of(fields: Column, kept: Column) -> Column:
        head = F.element_at(kept, 1)
        header = F.transform(F.slice(fields, head["before"] + 1, head["last"] - head["before"]), lambda f: F.lower(_unquoted(f)))
        return _let(header, lambda names: _let(
            F.array(*[_position(names, c) for c in columns]),
            lambda at: F.transform(F.slice(kept, 2, F.size(kept)), lambda s: F.transform(
                at, lambda p: F.when(p <= s["last"] - s["before"], _unquoted(F.element_at(fields, s["before"] + p)))))))

    text = F.regexp_replace(F.regexp_replace(F.col(text_col), "^﻿", ""), "\r\n?", "\n")
    fields = F.regexp_extract_all(F.concat(text, F.lit("\n")), F.lit(FIELD), F.lit(0))
    # the generator is a barrier: what is above it reads the values and does not cut the text again
    rows = files.select(*keep, F.explode_outer(_let(fields, records)).alias("_values")).where("_values IS NOT NULL")
    return rows.select(*keep, *[_typed(F.col("_values")[i], name, kind) for i, (name, kind) in enumerate(columns.items())])


def _position(names: Column, column: str) -> Column:
    at = F.array_position(names, F.lit(column.strip().lower())).cast("int")
    missing = F.concat(F.lit(f"no column {column!r} in the header: "), F.array_join(names, ", "))
    return F.when(at > 0, at).otherwise(F.raise_error(missing).cast("int"))


def _typed(value: Column, name: str, kind: str) -> Column:
    return (value if kind == "string" else value.try_cast(kind)).alias(name)


def _literal(path: str) -> str:
    """A path as Spark's readers take it: characters of file patterns stand for themselves."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header): the first line of each file that is not blank; a file without one is left out.

    A scan of lines that keeps one for each file and task; nothing is held but the smallest line number seen.
    """
    lines = spark.read.text([_literal(p) for p in paths]).where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^﻿|\r$", "").alias("line"), F.monotonically_increasing_id().alias("at"))
    return lines.where(F.col("line").rlike("[^ \\t]")).groupBy("path").agg(F.min_by("line", "at").alias("header"))


def read_by_header(spark: SparkSession, paths: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """(path, columns): the records of all ``paths`` by column name, a scan for each different header.

    ``columns`` and missing values are as in ``csv_rows``; a file whose header lacks one of the columns is an error. What passes through the driver is the
    list of files, which Spark's own listing holds there too. Paths come out as a listing shows them.
    """
    by_header: dict[str, list[str]] = {}
    if paths:
        for r in headers(spark, paths).select(plain_path("path").alias("path"), "header").collect():
            by_header.setdefault(r.header, []).append(r.path)
    out = spark.createDataFrame([], ", ".join(["path string", *[f"`{c}` {kind}" for c, kind in columns.items()]]))
    for header, files in sorted(by_header.items()):
        names = [c.strip().lower() for c in next(csv.reader([header], skipinitialspace=True))]
        if missing := [c for c in columns if c.strip().lower() not in names]:
            raise ValueError(f"no column {missing[0]!r} in the header: {', '.join(names)} ({files[0]})")
        reader = spark.read.schema(", ".join(f"c{i} string" for i in range(len(names)))).options(
            header=True, multiLine=True, escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
        rows = reader.csv([_literal(p) for p in sorted(files)])
        values = []
        for c, kind in columns.items():
            v = F.col(f"c{names.index(c.strip().lower())}")
            values.append(_typed(F.when(~v.isin(*MISSING), v), c, kind))
        out = out.union(rows.select(plain_path("_metadata.file_path"), *values))
    return out
