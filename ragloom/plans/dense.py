"""A collection with a user's embedding model: V1, K2, K4 and V4 together.

Two Parquet tables under one path. `vectors (hash, embedding)` holds one vector
per different text, named by the SHA-256 of the text; `rows (id, hash, document,
metadata)` holds the collection. Writing embeds only texts whose hash is not
stored yet: hashes meet the stored ones before the model, so writing a corpus
again, or a corpus that repeats its texts, calls the model once per text. Texts
cross the network once, to the model; a write that adds nothing moves hashes and ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.functions import infer as K
from ragloom.operators import prompts as G
from ragloom.operators import retrieve as R
from ragloom.operators import vectors as V
from ragloom.plans.sizing import broadcast_if_small
from ragloom.sources import store as ST

VECTORS = "hash string, embedding array<float>"


def text_hash(text_col: str = "document"):
    return F.sha2(F.coalesce(text_col, F.lit("")), 256)


def embed_absent(spark: SparkSession, texts: DataFrame, path: str, embedder: str, dim: int, text_col: str = "document") -> None:
    """Embed the texts that `{path}/vectors` lacks and append them. A vector of another
    length fails the write (V4) and leaves the table as it was."""
    vectors = f"{path.rstrip('/')}/vectors"
    stored = ST.open_store(spark, vectors, VECTORS, create=True)
    named = texts.select(text_hash(text_col).alias("hash"), F.col(text_col).alias("__text"))
    new = ST.absent_rows(named, named.select("hash").distinct(), stored, "hash")
    if new is None:
        return
    new = new.dropDuplicates(["hash"])
    out = V.assert_dimension(K.embed_named(new, "__text", embedder), "embedding", dim)
    out.select("hash", "embedding").write.mode("append").parquet(vectors)


def write(spark: SparkSession, rows: DataFrame, path: str, embedder: str, dim: int) -> DataFrame:
    """Add `rows (id, document, metadata)`: new texts are embedded, then rows of absent
    ids inserted (S13). Returns the rows added. Vectors come first, so a write
    that fails in between leaves no row without one."""
    embed_absent(spark, rows, path, embedder, dim)
    return ST.insert_absent(spark, rows.withColumn("hash", text_hash()), f"{path.rstrip('/')}/rows")


def search(spark: SparkSession, path: str, questions: DataFrame, q_key: str, text_col: str, embedder: str, k: int = 4,
           metric: str = "cosine") -> DataFrame:
    """J1 over the collection: `(q_key, rank, score, id, document, metadata)`, equal
    scores in the order of ids. Vectors are searched once per different text, under
    the smallest id that has it: a text among whose rows one is among the k best is
    itself among the k best texts, as each better text has a better row. Only rows of
    such texts are ranked within their text; if the hits are few, they are sent to the rows."""
    base = path.rstrip("/")
    rows = spark.read.parquet(f"{base}/rows")
    firsts = rows.groupBy("hash").agg(F.min("id").alias("first"))
    asked = K.embed_named(questions.select(q_key, text_col), text_col, embedder).select(q_key, "embedding")
    held = spark.read.parquet(f"{base}/vectors").join(firsts, "hash")
    near = R.knn_dense(asked, held.select("first", "embedding"), q_key, "first", "embedding", k, metric)
    met, few = broadcast_if_small(firsts.join(near.drop("rank"), "first"))
    found = met.select("hash").distinct()
    some = rows.join(F.broadcast(found) if few else found, "hash", "left_semi")
    same = R.top_k(some, ["hash"], [F.asc("id")], k, "__nth").drop("__nth")  # k rows of a text suffice
    hits = same.join(met, "hash")
    return R.top_k(hits, [q_key], [F.desc("score"), F.asc("id")], k).select(q_key, "rank", "score", "id", "document", "metadata")


def answers(questions: DataFrame, hits: DataFrame, q_key: str, text_col: str, model: str, options: dict | None = None) -> DataFrame:
    """A2 + G1 + K4: `(q_key, n_hits, prompt, answer)`, the hits of each question stuffed
    in rank order into the answer-only-from-context prompt."""
    ctx = G.stuff_context(questions.select(q_key, text_col), hits, q_key, "document")
    prompts = ctx.select(q_key, "n_hits", G.rag_prompt(F.col("context"), F.col(text_col)).alias("prompt"))
    return K.generate_named(prompts, "prompt", model, "answer", options)
