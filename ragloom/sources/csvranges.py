"""S2 by byte ranges: one document per CSV row, a file of any size in many tasks.

Spark's text scan cuts a file into ranges of whole lines, and a record may go
on over lines (and ranges) where a line break is quoted. Whether it does
depends on one bit, and a line maps that bit to the next: most lines keep it, a
line with an odd quote turns it, a line that ends a quoted field sets it.

Pass one reads each range and keeps only what its lines do to the bit, from
either value, and how many records begin in it. A window over the ranges of
a file (one row each) tells every range the bit and the record number it begins
with. Pass two reads the ranges again, parses the records that lie inside
one, and sends only the pieces of records that cross a cut to be joined.

A file is all or nothing: one record that cannot be read rejects it.
"""

from __future__ import annotations

import csv
import io
import sys

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_RANGE = ["source", "start"]


def walk(line: str, quoted: bool) -> bool:
    """Whether a quoted field is open after the line, as the csv module reads it: a quote
    opens a field only at its beginning, and a doubled one does not close it."""
    i = 0
    while True:
        if not quoted:
            if line[i:i + 1] == '"':
                quoted, i = True, i + 1
                continue
        else:
            j = line.find('"', i)
            if j < 0:
                return True
            if line[j + 1:j + 2] == '"':
                i = j + 2
                continue
            quoted, i = False, j + 1
        k = line.find(",", i)
        if k < 0:
            return False
        i = k + 1


def _steps(line: str) -> tuple[bool, bool]:
    return (walk(line, False), walk(line, True)) if '"' in line else (False, True)


def _blank(line: str) -> bool:
    return not line.strip("\r")


def rows_of(record: str, header: list[str]) -> list[str]:
    """The documents of a record's text: `column: value` lines."""
    return ["\n".join(f"{k.strip() if k else k}: {v.strip() if isinstance(v, str) else v}" for k, v in row.items())
            for row in csv.DictReader(io.StringIO(record), fieldnames=header)]


def whole_files(batches):
    """Rows (path, content) to (source, page, text, error): files parsed whole, as a
    stream hands them over one by one; all of a file or nothing."""
    import pyarrow as pa
    csv.field_size_limit(sys.maxsize)
    for b in batches:
        for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            try:
                text = content.decode("utf-8-sig").lstrip("\r\n")
                header = next(csv.reader(io.StringIO(text)), [])
                out = [(path, page - 1, x, None) for page, x in enumerate(rows_of(text, header)) if page]
            except (csv.Error, UnicodeDecodeError) as e:
                out = [(path, None, None, f"{type(e).__name__}: {e}")]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True), (pa.string(), pa.int32(), pa.string(), pa.string()), strict=True)], ["source", "page", "text", "error"])


def _lines(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(source, start, line): lines as bytes, in order within a range."""
    text = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("lineSep", "\n").text(root))
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return text.select(F.regexp_replace(path, "^file:///", "file:/").alias("source"), F.col("_metadata.file_block_start").alias("start"),
                       F.col("value").cast("binary").alias("line"))


def _in_ranges(batches):
    """Rows of a task range by range: (source, start, lines as an iterator) is one call of `take`."""
    for b in batches:
        columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
        yield from zip(*columns, strict=True)


def _survey(batches):
    """Per range: where the bit goes from 0 and from 1, records that begin from either,
    the first record if the range begins the file and ends it, invalid text."""
    import pyarrow as pa
    kinds = {"source": pa.string(), "start": pa.int64(), "to0": pa.bool_(), "to1": pa.bool_(), "n0": pa.int64(), "n1": pa.int64(),
             "header": pa.string(), "bad": pa.string()}
    now, state = None, None

    def result():
        s = state
        header = "\n".join(s["head"]) if now[1] == 0 and s["done"] else None
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
            (*now, s["q"][0], s["q"][1], s["n"][0], s["n"][1], header, s["bad"]), kinds.values(), strict=True)], list(kinds))

    for source, start, raw in _in_ranges(batches):
        if (source, start) != now:
            if now is not None:
                yield result()
            now, state = (source, start), {"q": [False, True], "n": [0, 0], "head": [], "done": False, "bad": None}
        s = state
        try:
            line = raw.decode("utf-8")
        except UnicodeDecodeError as e:
            s["bad"] = s["bad"] or f"UnicodeDecodeError: {e.reason}"
            continue
        if start == 0 and not s["n"][0] and not s["head"]:
            line = line.removeprefix("\ufeff")
        for entry in (0, 1):
            if not s["q"][entry] and not _blank(line):
                s["n"][entry] += 1
        to = _steps(line)
        if start == 0 and not s["done"] and (s["q"][0] or not _blank(line)):
            s["head"].append(line)
            s["done"] = not to[s["q"][0]]
        s["q"] = [to[x] for x in s["q"]]
    if now is not None:
        yield result()


def ranges(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(source, start, quoted, first, header, bad): what every range begins with. One row per
    range, that is, per `spark.sql.files.maxPartitionBytes` of input."""
    found = _lines(spark, root, glob).mapInArrow(
        _survey, "source string, start long, to0 boolean, to1 boolean, n0 long, n1 long, header string, bad string")
    before = Window.partitionBy("source").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fixed, turns = F.col("to0") == F.col("to1"), (F.col("to0") & ~F.col("to1")).cast("int")
    # the bit before a range: what the last range that sets it has set, turned by those after it
    found = found.withColumn("turned", F.coalesce(F.sum(turns).over(before), F.lit(0)))
    last = F.last(F.when(fixed, F.struct(F.col("to0").alias("bit"), "turned")), ignorenulls=True).over(before)
    odd = F.pmod(F.col("turned") - F.coalesce(F.col("last.turned"), F.lit(0)), F.lit(2)) == 1
    found = found.withColumn("last", last).withColumn("quoted", F.coalesce(F.col("last.bit"), F.lit(False)) != odd)
    n = F.when(F.col("quoted"), F.col("n1")).otherwise(F.col("n0"))
    whole = Window.partitionBy("source")
    return found.withColumn("first", F.coalesce(F.sum(n).over(before), F.lit(0))).select(
        *_RANGE, "quoted", "first", F.max("header").over(whole).alias("header"), F.max("bad").over(whole).alias("bad"))


def _cut(batches):
    """Lines with what their range begins with: documents of the records inside it
    (source, page, text, error), and pieces (source, page, start, piece) of those that cross a cut."""
    import pyarrow as pa
    kinds = {"source": pa.string(), "page": pa.int64(), "text": pa.string(), "error": pa.string(), "start": pa.int64(), "piece": pa.string()}
    csv.field_size_limit(sys.maxsize)
    out: list[tuple] = []

    def batch():
        rows, out[:] = list(out), []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], list(kinds))

    now, quoted, number, lines, entered, header, names = None, False, 0, [], False, None, []

    def close(complete):
        """The record gathered so far; the header is record 0, and pages count from 0 after it."""
        nonlocal lines
        if lines and (number > 0 or header is None):  # a header that crosses a cut is joined as page -1
            source, start = now
            if number > 0 and entered and complete and header is not None:
                try:
                    out.extend((source, number - 1, text, None, None, None) for text in rows_of("\n".join(lines), names))
                except csv.Error as e:
                    out.append((source, None, None, f"{type(e).__name__}: {e}", None, None))
            else:
                out.append((source, number - 1, None, None, start, "\n".join(lines)))
        lines = []

    for source, start, raw, begins_quoted, first, head in _in_ranges(batches):
        if (source, start) != now:
            close(not quoted)
            now, quoted, number, entered, header = (source, start), begins_quoted, first - 1, False, head
            names = next(csv.reader(io.StringIO(header)), []) if header is not None else []
        line = raw.decode("utf-8")
        if start == 0 and number < 0:
            line = line.removeprefix("\ufeff")
        if not quoted:
            close(True)
            if _blank(line):
                continue
            number, entered = number + 1, True
        lines.append(line)
        quoted = _steps(line)[quoted]
        if len(out) >= 4096:
            yield batch()
    close(not quoted)
    if out:
        yield batch()


def _joined(header, record):
    """Documents of records that were cut; null for one that cannot be read."""
    import pyarrow as pa
    csv.field_size_limit(sys.maxsize)
    out = []
    for h, r in zip(header.to_pylist(), record.to_pylist(), strict=True):
        try:
            out.append({"texts": rows_of(r, next(csv.reader(io.StringIO(h)), [])), "error": None})
        except csv.Error as e:
            out.append({"texts": None, "error": f"{type(e).__name__}: {e}"})
    return pa.array(out, pa.struct([("texts", pa.list_(pa.string())), ("error", pa.string())]))


def scan(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(source, page, text, error): the documents of every CSV file, or its first error."""
    known = ranges(spark, root, glob)
    # one row per range of the input, a few hundred bytes for its 64 MB or more
    lines = _lines(spark, root, glob).join(F.broadcast(known.where("bad IS NULL").drop("bad")), _RANGE)
    found = lines.select(*_RANGE, "line", "quoted", "first", "header").mapInArrow(
        _cut, "source string, page long, text string, error string, start long, piece string")
    pieces = found.where("piece IS NOT NULL").groupBy("source", "page").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "piece"))), lambda x: x["piece"]), "\n").alias("record"))
    heads = known.select("source", "header").where("header IS NOT NULL").unionByName(
        pieces.where("page < 0").select("source", F.col("record").alias("header"))).groupBy("source").agg(F.max("header").alias("header"))
    pieces = pieces.where("page >= 0")
    parse = F.arrow_udf(_joined, "struct<texts:array<string>,error:string>")
    whole = pieces.join(heads, "source").withColumn("parsed", parse(F.coalesce("header", F.lit("")), F.col("record")))
    whole = whole.select("source", F.when(F.col("parsed.error").isNull(), F.col("page")).alias("page"),
                         F.explode(F.coalesce("parsed.texts", F.array(F.lit(None).cast("string")))).alias("text"), F.col("parsed.error").alias("error"))
    rows = found.where("piece IS NULL").select("source", "page", "text", "error").unionByName(whole)
    bad = known.where("bad IS NOT NULL").select("source", F.col("bad").alias("error")).unionByName(
        rows.where("error IS NOT NULL").select("source", "error")).groupBy("source").agg(F.min("error").alias("error"))
    good = rows.where("error IS NULL").join(bad.select("source"), "source", "left_anti")
    return good.select("source", F.col("page").cast("int").alias("page"), "text", "error").unionByName(
        bad.select("source", F.lit(None).cast("int").alias("page"), F.lit(None).cast("string").alias("text"), "error"))
