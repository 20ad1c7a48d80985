"""The two end-to-end flows of the reference, composed from the operators.

E1 `embed_directory`: walk a directory → route by suffix → quarantine bad
files → recursive chunks → sanitised metadata → hashed term counts → insert
into the collection (or replace it with `clear=True`).

E2 `chat_prompts`: recorded conversations → blank/exit handling → exchanges →
bounded history → enlarged question → search → stuffed context → prompt.
With a user generator (K4) the prompts become answers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.operators import chunk as C
from ragloom.operators import metadata as M
from ragloom.operators import prompts as G
from ragloom.operators import retrieve as R
from ragloom.operators import sessions as S
from ragloom.operators import vectors as V
from ragloom.plans import collection as COL
from ragloom.sources import files as FS
from ragloom.sources import store as ST


def document_rows(docs: DataFrame, size: int = C.DEFAULT_CHUNK_SIZE, overlap: int = C.DEFAULT_CHUNK_OVERLAP,
                  dims: int = V.DEFAULT_DIMS) -> DataFrame:
    """Documents `(source, page, text)` → collection rows: recursive chunks
    (C2), sanitised metadata (P4), hashed term counts as aligned arrays, and
    deterministic ids `{source}_{page}_{chunk}`; `chunk_no` holds page and chunk
    in the upper and lower half of a long. A chunk without tokens is stored
    with empty arrays. Used by the batch
    flow (E1) and, per micro-batch, by the streaming ingest (S16)."""
    chunks = C.chunk_recursive(docs, "text", size, overlap)
    meta = M.sanitize_metadata(F.parse_json(F.to_json(F.struct(F.col("source"), F.col("page")))))
    chunks = chunks.select(F.col("source").alias("doc_id"), "page",
                           F.concat_ws("_", "source", F.col("page").cast("string"), F.col("chunk_no").cast("string")).alias("id"),
                           (F.shiftleft(F.col("page").cast("long"), 32) + F.col("chunk_no")).alias("chunk_no"),
                           "chunk", meta.alias("metadata"))
    tf = V.hashed_tf(chunks, ["doc_id", "chunk_no"], "chunk", dims)
    arrays = (tf.groupBy("doc_id", "chunk_no")
                .agg(F.array_sort(F.collect_list(F.struct("dim", "tf"))).alias("__p"))
                .select("doc_id", "chunk_no", F.transform("__p", lambda x: x["dim"]).alias("dims"),
                        F.transform("__p", lambda x: x["tf"]).alias("tfs")))
    return COL.with_counts(chunks, arrays).select("id", "doc_id", "chunk_no", F.col("chunk").alias("document"),
                                                  "metadata", "dims", "tfs")


def embed_directory(spark: SparkSession, root: str, store_path: str, extractors: dict[str, Callable] | None = None,
                    size: int = C.DEFAULT_CHUNK_SIZE, overlap: int = C.DEFAULT_CHUNK_OVERLAP,
                    dims: int = V.DEFAULT_DIMS, clear: bool = False) -> dict:
    """E1. Returns counts (documents, rejects, chunks, added) and the store path
    in use (`clear` swaps a complete new version into `store_path`)."""
    docs, rejects = FS.load_directory(spark, root, extractors)
    docs = docs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "source")
    rows = document_rows(docs, size, overlap, dims)
    path = store_path
    if clear:
        path = ST.overwrite(spark, rows, store_path)
        added = spark.read.parquet(path).count()
    else:
        added = COL.write(spark, rows, store_path).count()
    return {"documents": docs.count(), "rejects": rejects.count(), "chunks": rows.count(),
            "added": added, "store": path}


def exchanges_with_history(turns: DataFrame, n: int = S.DEFAULT_HISTORY) -> DataFrame:
    """W4 + W1 over recorded turns, keyed by (conversation, position) at every
    size: no task holds a whole conversation."""
    return S.last_n_exchanges_balanced(S.exchanges_balanced(turns), n)


def chat_queries(turns: DataFrame, n: int = S.DEFAULT_HISTORY) -> DataFrame:
    """Per user question: `(conv_id, turn, question, query)` where `query` is the
    history-enlarged text that gets embedded and searched."""
    ex = exchanges_with_history(turns, n)
    return ex.select("conv_id", "turn", F.col("q").alias("question"), G.history_query("history", "q").alias("query"))


def chat_prompts(spark: SparkSession, turns: DataFrame, corpus_chunks: DataFrame, k: int = 4,
                 n: int = S.DEFAULT_HISTORY, dims: int = V.DEFAULT_DIMS, sf_dir: str | None = None) -> DataFrame:
    """E2 over recorded conversations: `(conv_id, turn, n_hits, prompt)`.

    `corpus_chunks` has `(doc_id, chunk_no, chunk)`; only their bags of buckets cross the
    network (see `retrieve.knn_text`). With `sf_dir` the hit texts are read
    back from the `documents` table with the hit ids pushed into the scan."""
    q = chat_queries(turns, n).drop("question")
    hits = R.knn_text(q, corpus_chunks, ["conv_id", "turn"], ["doc_id", "chunk_no"], "query", "chunk", k, dims)
    if sf_dir is not None:
        from ragloom.plans.rag import attach_chunk_text
        with_text = attach_chunk_text(spark, sf_dir, hits)
    else:
        from ragloom.plans.sizing import broadcast_if_small
        hits, _ = broadcast_if_small(hits)
        with_text = corpus_chunks.select("doc_id", "chunk_no", "chunk").join(hits, ["doc_id", "chunk_no"])
    ctx = (with_text.groupBy("conv_id", "turn")
                    .agg(F.count(F.lit(1)).alias("n_hits"),
                         F.expr("listagg(chunk, '\\n\\n') WITHIN GROUP (ORDER BY rank)").alias("context")))
    out = q.join(ctx, ["conv_id", "turn"], "left")
    context = F.coalesce(F.col("context"), F.lit(G.NO_CONTEXT))
    return out.select("conv_id", "turn", F.coalesce("n_hits", F.lit(0)).cast("long").alias("n_hits"),
                      G.rag_prompt(context, F.col("query")).alias("prompt"))
