"""Document sources: S1 text, S2 CSV rows, S3 Markdown, S4 AsciiDoc, S5 binary
formats through a user extractor, S6 routing by extension, S7 quarantine of
unreadable files, S8 flat directory scan, U1 union of formats.

Every loader is a Spark file scan: files are split across tasks by Spark's
file index, and a file's text never passes through the driver. One row is
one document `(source, page, text, error)`; a file that cannot be read is a
row in the *rejects* output (`error` not null) and the run continues.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragloom.sources import csvranges

# The suffixes the loader knows (compared lower-cased).
KNOWN_SUFFIXES = (".txt", ".pdf", ".csv", ".docx", ".md", ".adoc")
TEXT_SUFFIXES = (".txt", ".md", ".adoc")

DOC_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("error", T.StringType()),
])


def suffix(path: Column | str) -> Column:
    """lower-cased file suffix including the dot ('' when none)."""
    p = F.col(path) if isinstance(path, str) else path
    return F.lower(F.regexp_extract(p, r"(\.[^./]+)$", 1))


def ci_glob(sfx: str) -> str:
    """Case-insensitive file-name glob for a suffix: '.txt' → '*.[tT][xX][tT]'."""
    return "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in sfx)


def scan_suffix(spark: SparkSession, root: str, sfx: str, recursive: bool = True) -> DataFrame:
    """Files with suffix `sfx` (any case). The glob is applied while listing,
    so other files' bytes are never read."""
    return scan_files(spark, root, recursive, ci_glob(sfx))


def scan_files(spark: SparkSession, root: str, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """All files under `root` as `binaryFile` rows `(path, length, content)`.
    Content is read lazily: filters on `path` / `length` are evaluated before
    a file's bytes are loaded."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length", "content")


def _decode_text(files: DataFrame) -> DataFrame:
    """S7 for text files: bytes → UTF-8 text, invalid bytes → reject row."""
    s = F.col("content").cast("string")
    ok = F.is_valid_utf8(s)
    return files.select(F.col("path").alias("source"), F.lit(0).alias("page"),
                        F.when(ok, s).alias("text"),
                        F.when(~ok, F.lit("invalid UTF-8")).alias("error"))


def scan_text(spark: SparkSession, root: str) -> DataFrame:
    """One document per `.txt` file (any case), recursive."""
    return _decode_text(scan_suffix(spark, root, ".txt"))


# Markdown → plain text: a documented subset of marks (headings, emphasis,
# links and images, code fences and inline code, list bullets, quotes, rules).
# Emphasis needs a mark that touches no letter, digit or like mark on its outer
# side, so `snake_case` and `2*3*4` stay; line rules never cross a line break.
_FENCE = r"(?m)^ {0,3}```[^\n]*$"
_MD_RULES = [
    (r"!\[([^\]]*)\]\([^)]*\)", "$1"),
    (r"\[([^\]]*)\]\([^)]*\)", "$1"),
    (r"(?m)^ {0,3}#{1,6}[ \t]+", ""),
    (r"(?m)^ {0,3}>[ \t]?", ""),
    (r"(?m)^[ \t]*([-*_][ \t]*){3,}$", ""),
    (r"(?m)^[ \t]*[-*+][ \t]+", ""),
    (r"(?<![\p{L}\p{N}*`])\*\*(?=\S)(.+?)(?<=\S)\*\*(?![\p{L}\p{N}*`])", "$1"),
    (r"(?<![\p{L}\p{N}_`])__(?=\S)(.+?)(?<=\S)__(?![\p{L}\p{N}_`])", "$1"),
    (r"(?<![\p{L}\p{N}*`])\*(?=\S)([^*\n]*?)(?<=\S)\*(?![\p{L}\p{N}*`])", "$1"),
    (r"(?<![\p{L}\p{N}_`])_(?=\S)([^_\n]*?)(?<=\S)_(?![\p{L}\p{N}_`])", "$1"),
    (r"`([^`\n]*)`", "$1"),
    (r"\n{3,}", "\n\n"),
]

# AsciiDoc → plain text subset: titles, attributes, block delimiters, links, emphasis.
_ADOC_LISTING = r"(?m)^-{4,}[ \t]*$\n?"
_ADOC_RULES = [
    (r"(?m)^:[A-Za-z0-9_-]+:.*$\n?", ""),
    (r"(?m)^(====|\*\*\*\*|____|\.\.\.\.|\+\+\+\+)[ \t]*$\n?", ""),
    (r"(?m)^=+[ \t]+", ""),
    (r"(?m)^\.(?=\p{L})", ""),
    (r"(?:link:)?(?:https?://[^\[\s]+)\[([^\]]*)\]", "$1"),
    (r"(?<![\p{L}\p{N}*`])\*(?=\S)([^*\n]*?)(?<=\S)\*(?![\p{L}\p{N}*`])", "$1"),
    (r"(?<![\p{L}\p{N}_`])_(?=\S)([^_\n]*?)(?<=\S)_(?![\p{L}\p{N}_`])", "$1"),
    (r"`([^`\n]+)`", "$1"),
    (r"\n{3,}", "\n\n"),
]


def _apply(col: Column, rules, code: str) -> Column:
    """`rules` over the prose between lines matching `code`; what stands
    between the first and second such line (third and fourth ...) is code and
    stays as it is."""
    def prose(c):
        for pat, rep in rules:
            c = F.regexp_replace(c, pat, rep)
        return c
    parts = F.transform(F.split(col, code), lambda c, i: F.when(i % 2 == 0, prose(c)).otherwise(c))
    return F.trim(F.array_join(parts, ""))


def markdown_to_text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return _apply(c, _MD_RULES, _FENCE)


def asciidoc_to_text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return _apply(c, _ADOC_RULES, _ADOC_LISTING)


def scan_markdown(spark: SparkSession, root: str) -> DataFrame:
    """S3: `.md` files to plain text (regex chain, JVM side)."""
    docs = _decode_text(scan_suffix(spark, root, ".md"))
    return docs.withColumn("text", markdown_to_text("text"))


def scan_asciidoc(spark: SparkSession, root: str) -> DataFrame:
    """`.adoc` files to plain text, one document per file."""
    docs = _decode_text(scan_suffix(spark, root, ".adoc"))
    return docs.withColumn("text", asciidoc_to_text("text"))


def scan_csv_docs(spark: SparkSession, root: str) -> DataFrame:
    """One document per CSV row, `column: value` lines; `page` holds the 0-based
    row number within its file. Files are read by byte ranges (see `csvranges`):
    one file is as many tasks as it needs, and no file is held whole. A file
    that cannot be read to its end is one reject and gives no documents."""
    return csvranges.scan(spark, root, ci_glob(".csv"))


def _extract_with(extractor: Callable[[bytes, str], list[str] | str]):
    def run(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    pages = extractor(bytes(content), path)
                    out = [(path, i, p, None) for i, p in enumerate([pages] if isinstance(pages, str) else pages)]
                except Exception as e:  # noqa: BLE001 — all of a file or nothing
                    out = [(path, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(out, columns=["source", "page", "text", "error"])
    return run


def scan_binary(spark: SparkSession, root: str, extractor: Callable, suffixes=(".pdf", ".docx"),
                recursive: bool = True, glob: str | None = None) -> DataFrame:
    """Binary documents through a user-supplied `extractor(bytes, path)`
    returning one text or a list of page texts. Runs in the Python worker per
    file (Arrow batches of files); exceptions become reject rows."""
    parts = [scan_files(spark, root, recursive, glob or ci_glob(sfx)) for sfx in suffixes]
    files = parts[0]
    for p in parts[1:]:
        files = files.unionByName(p)
    return files.mapInPandas(_extract_with(extractor), DOC_SCHEMA)


def known_glob() -> str:
    """Glob of all known suffixes, in any case."""
    return "{" + ",".join(map(ci_glob, KNOWN_SUFFIXES)) + "}"


def parse_files(files: DataFrame, extractors: dict[str, Callable] | None = None) -> DataFrame:
    """S6 + S7 over files at hand `(path, content)`: `(source, page, text, error)` of every
    known suffix; unknown ones are skipped. The form of `load_directory` for
    a micro-batch of a stream."""
    extractors = dict(extractors or {})
    sfx = suffix("path")
    text = _decode_text(files.where(sfx.isin(*TEXT_SUFFIXES)))
    kind = suffix("source")
    text = text.withColumn("text", F.when(kind == ".md", markdown_to_text("text")).when(
        kind == ".adoc", asciidoc_to_text("text")).otherwise(F.col("text")))
    out = text.unionByName(files.where(sfx == ".csv").select("path", "content").mapInArrow(csvranges.whole_files, DOC_SCHEMA))
    for one in KNOWN_SUFFIXES:
        if one in extractors:
            out = out.unionByName(files.where(sfx == one).select("path", "content").mapInPandas(_extract_with(extractors[one]), DOC_SCHEMA))
        elif one not in (*TEXT_SUFFIXES, ".csv"):
            out = out.unionByName(files.where(sfx == one).select(
                F.col("path").alias("source"), F.lit(None).cast("int").alias("page"), F.lit(None).cast("string").alias("text"),
                F.lit(f"no extractor registered for {one}").alias("error")))
    return out


def scan_flat_dir(spark: SparkSession, root: str, extractor: Callable, ext: str = ".pdf") -> DataFrame:
    """Only the files directly inside `root` whose name ends with `ext`
    (case-sensitive, no recursion)."""
    files = (spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*{ext}")
             .select("path", "length", "content"))
    return files.mapInPandas(_extract_with(extractor), DOC_SCHEMA)


def load_directory(spark: SparkSession, root: str, extractors: dict[str, Callable] | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """S6 + S7 + U1 + K1: walk `root`, route each file by its lower-cased
    suffix, union all formats; unknown suffixes are skipped. Returns
    (documents, rejects). `extractors` maps suffixes such as ".pdf" or ".docx"
    to user functions (K1); a known binary suffix without an extractor is
    rejected with a message."""
    extractors = dict(extractors or {})
    parts = [scan_text(spark, root), scan_markdown(spark, root), scan_asciidoc(spark, root),
             scan_csv_docs(spark, root)]
    for sfx in (".pdf", ".docx"):
        if sfx in extractors:
            parts.append(scan_binary(spark, root, extractors[sfx], (sfx,)))
        else:
            missing = scan_suffix(spark, root, sfx).select(
                F.col("path").alias("source"), F.lit(None).cast("int").alias("page"),
                F.lit(None).cast("string").alias("text"),
                F.lit(f"no extractor registered for {sfx}").alias("error"))
            parts.append(missing)
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p, allowMissingColumns=True)
    docs = allp.filter(F.col("error").isNull()).drop("error")
    rejects = allp.filter(F.col("error").isNotNull()).select("source", "error")
    return docs, rejects
