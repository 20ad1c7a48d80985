"""The retrieval plan over the driver tables: documents → chunks → vectors,
benchmark questions → vectors → top-k chunks → context → prompt.

Partitioning: the corpus side is hash-partitioned once on `doc_id` (the
input documents are shuffled a single time). Every later per-chunk step —
term counts `(doc_id, chunk_no, dim)`, the norm window over
`(doc_id, chunk_no)` and the `(question, doc_id, chunk_no)` score sum — is
clustered by a superset of `doc_id`, so Spark plans no further exchange on
the corpus. The IDF table (at most `dims` rows) and the question postings
(row-count checked) are the only broadcasts.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.operators import chunk as C
from ragloom.operators import retrieve as R
from ragloom.operators import vectors as V
from ragloom.plans.sizing import broadcast_if_small
from ragloom.session import table

CORPUS_KEYS = ["doc_id", "chunk_no"]
QUESTION_KEYS = ["item_id"]


def corpus_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks(spark: SparkSession, sf_dir: str, size: int = C.DEFAULT_CHUNK_SIZE,
           overlap: int = C.DEFAULT_CHUNK_OVERLAP) -> DataFrame:
    """C1 over `documents`, partitioned by `doc_id` (one shuffle of the input)."""
    docs = (table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
            .repartition(corpus_partitions(spark), "doc_id"))
    return C.chunk_fixed(docs, "text", size, overlap).drop("text")


def corpus_vectors(spark: SparkSession, sf_dir: str, dims: int = V.DEFAULT_DIMS, weighting: str = "tfidf",
                   normalize: bool = True):
    """(chunk table, sparse vectors, idf table or None)."""
    ch = chunks(spark, sf_dir)
    vecs, idf = V.embed_corpus(ch, CORPUS_KEYS, "chunk", dims, weighting, normalize)
    return ch, vecs, idf


def question_vectors(spark: SparkSession, sf_dir: str, idf: DataFrame | None, dims: int = V.DEFAULT_DIMS):
    qs = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return qs, V.embed_queries(qs, QUESTION_KEYS, "text", dims, idf)


def corpus_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 over `documents`: `(doc_id, chunk_no, chunk)`, where they lie. Only a table of fewer
    pieces than the session has partitions is spread first, or a few tasks would cut it all."""
    return chunks_in_place(spark, sf_dir, ["doc_id", "text"]).select(*CORPUS_KEYS, "chunk")


def chunks_in_place(spark: SparkSession, sf_dir: str, columns=("doc_id", "text", "lang", "source")) -> DataFrame:
    """The rows of `chunks`, cut where the documents lie (see `corpus_texts`)."""
    docs = table(spark, sf_dir, "documents").select(*columns)
    if docs.rdd.getNumPartitions() < corpus_partitions(spark):
        docs = docs.repartition(corpus_partitions(spark), "doc_id")
    return C.chunk_fixed(docs, "text", C.DEFAULT_CHUNK_SIZE, C.DEFAULT_CHUNK_OVERLAP).drop("text")


def search(spark: SparkSession, sf_dir: str, k: int = 4, dims: int = V.DEFAULT_DIMS,
           weighting: str = "tfidf", method: str = "auto") -> DataFrame:
    """J2 + T1: `(item_id, doc_id, chunk_no, score, rank)` for every benchmark item."""
    if method != "join" or weighting == "tf":
        qs = table(spark, sf_dir, "benchmark").select("item_id", "text")
        return R.knn_text(qs, corpus_texts(spark, sf_dir), QUESTION_KEYS, CORPUS_KEYS, "text", "chunk", k, dims, weighting, method)
    _, cvec, idf = corpus_vectors(spark, sf_dir, dims, weighting, normalize=False)
    _, qvec = question_vectors(spark, sf_dir, idf, dims)
    return R.knn_sparse(qvec, cvec, QUESTION_KEYS, CORPUS_KEYS, k, method=method, corpus_normalized=False)


def hits_with_text(spark: SparkSession, sf_dir: str, k: int = 4, dims: int = V.DEFAULT_DIMS,
                   weighting: str = "tfidf") -> DataFrame:
    """Top-k hits joined back to their chunk text (k rows per question)."""
    return attach_chunk_text(spark, sf_dir, search(spark, sf_dir, k, dims, weighting))


MAX_PUSHED_IDS = 10_000


def attach_chunk_text(spark: SparkSession, sf_dir: str, hits: DataFrame, size: int = C.DEFAULT_CHUNK_SIZE,
                      overlap: int = C.DEFAULT_CHUNK_OVERLAP) -> DataFrame:
    """Join hits `(…, doc_id, chunk_no, …)` to their chunk text.

    The hit list is small (k per question, size-checked) and broadcast. Its
    document ids (when there are at most `MAX_PUSHED_IDS`) also go into the
    Parquet scan as an `IN` filter, so only row groups that can hold a hit are
    read; the chunks are cut in the scanning task (no shuffle of the text)."""
    hits, _ = broadcast_if_small(hits)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = hits.select("doc_id").distinct().limit(MAX_PUSHED_IDS + 1).toPandas()["doc_id"].tolist()
    if len(ids) <= MAX_PUSHED_IDS:
        docs = docs.filter(F.col("doc_id").isin(ids))
    ch = C.chunk_fixed(docs, "text", size, overlap).select(*CORPUS_KEYS, "chunk")
    return ch.join(hits, CORPUS_KEYS)


#: Words of a gram by which passages and documents meet.
GRAM = 3


def _grams(tokens):
    """Arrow: per list of tokens, the hash of each run of GRAM tokens and of each token."""
    import hashlib

    import numpy as np
    import pyarrow as pa
    words = tokens.flatten().dictionary_encode()
    named = words.dictionary.to_pylist()
    number = np.array([int.from_bytes(hashlib.md5(w.encode()).digest()[:8], "little") for w in named], np.uint64)
    flat = number[np.asarray(words.indices)] if named else np.empty(0, np.uint64)
    ends = np.r_[0, np.cumsum(np.asarray(tokens.value_lengths().fill_null(0)))]
    long = np.zeros(max(len(flat) - GRAM + 1, 0), np.uint64)
    for j in range(GRAM):
        long = long * np.uint64(0x9E3779B97F4A7C15) + flat[j:j + len(long)] + np.uint64(j + 1)
    long, flat = long.view(np.int64), flat.view(np.int64)
    n = np.maximum(np.diff(ends) - GRAM + 1, 0)
    cut = np.r_[0, np.cumsum(n)]
    at = np.arange(cut[-1]) + np.repeat(ends[:-1] - cut[:-1], n)
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(long[at])),
                                       pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["runs", "words"])


def contained_pairs(passages: DataFrame, docs: DataFrame) -> DataFrame:
    """`(item_id, doc_id)`, each once, where the passage `(item_id, text)` occurs literally in
    the document `(doc_id, text)`.

    The inner words of a passage (all but its first and last, which may stand inside a
    longer word there) are consecutive words of the document. So a passage is known by
    its rarest inner gram: GRAM words, or one if it has fewer inner words. Documents that
    have the gram meet the passage by an equi-join (skewed grams are split by Spark)
    and are searched for the whole text. Passages without an inner word, and those of
    no text (which occur nowhere), cannot be known by words: they are searched for
    in every document."""
    grams = F.arrow_udf(_grams, "struct<runs:array<bigint>,words:array<bigint>>")
    words = F.filter(V.tokens("text"), lambda t: t != "")
    known = passages.where("text <> ''").withColumn("n", F.size(words) - 2)
    inner = known.where("n > 0").select("item_id", "n", grams(F.slice(words, F.lit(2), F.col("n"))).alias("g"))
    inner = inner.select("item_id", F.explode(F.array_distinct(F.when(F.col("n") >= GRAM, F.col("g.runs")).otherwise(F.col("g.words")))).alias("gram"))
    held = docs.select("doc_id", grams(V.tokens("text")).alias("g"))
    held = held.select("doc_id", F.explode(F.array_distinct(F.concat("g.runs", "g.words"))).alias("gram"))
    held = held.join(inner.select("gram").distinct(), "gram").distinct()
    held = held.persist(StorageLevel.MEMORY_AND_DISK)  # counted and searched: documents are cut into grams once
    df = held.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    rarest = inner.join(df, "gram", "left").groupBy("item_id").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram")).alias("least"))
    asked = rarest.where("least.df > 0").select("item_id", F.col("least.gram").alias("gram"))
    met = held.join(asked, "gram").select("item_id", "doc_id")
    passage = passages.select("item_id", F.col("text").alias("passage"))
    found = docs.join(met, "doc_id").join(passage, "item_id").where(F.instr(F.col("text"), F.col("passage")) > 0)
    short = known.where("n <= 0").select("item_id", F.col("text").alias("passage"))
    every = docs.join(short, F.instr(F.col("text"), F.col("passage")) > 0)
    return found.select("item_id", "doc_id").unionByName(every.select("item_id", "doc_id")).distinct()


def gold_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(item_id, doc_id)` where the benchmark passage occurs literally in the document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contained_pairs(table(spark, sf_dir, "benchmark").select("item_id", "text"), docs)


def contexts(spark: SparkSession, sf_dir: str, k: int = 4, sep: str = "\n\n", dims: int = V.DEFAULT_DIMS,
             weighting: str = "tfidf") -> DataFrame:
    """A2: per question, the k hit texts concatenated in rank order."""
    from ragloom.operators.prompts import stuff_context
    hits = hits_with_text(spark, sf_dir, k, dims, weighting)
    qs = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("question"))
    return stuff_context(qs, hits, "item_id", "chunk", sep)
