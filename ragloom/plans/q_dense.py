"""Registered queries of the dense collection: a user's embedding model (here the
hashed stand-in), searched, prompted and answered by a user's text model."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ragloom.functions import infer as K
from ragloom.operators import chunk as C
from ragloom.operators import prompts as G
from ragloom.plans import dense as DC
from ragloom.plans import oracle as O
from ragloom.plans.catalog import register
from ragloom.session import table

DIM, HITS = 64, 2
PREFIX = "Said: "


def _signed(prompts, options):
    """A stand-in text model: names the prompt by its length and digest."""
    return [f"{options['prefix']}{len(p)} {hashlib.md5(p.encode()).hexdigest()}" for p in prompts]


K.register_embedder("hashed-64", lambda: K.hashed_dense_embedder(DIM))
K.register_generator("signed", lambda: _signed)


def _rows(spark, sf_dir):
    ch = C.chunk_fixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "text")  # cut where they lie
    return ch.select(F.concat_ws("_", F.col("doc_id").cast("string"), F.col("chunk_no").cast("string")).alias("id"),
                     F.col("chunk").alias("document"), F.create_map(F.lit("source"), F.col("source")).alias("metadata"))


def _collection(spark, sf_dir) -> str:
    """The chunks written twice: the second time nothing is embedded or added."""
    from ragloom.streaming.retrieve import scratch_path
    path = scratch_path(spark, "dense")
    for _ in range(2):
        DC.write(spark, _rows(spark, sf_dir), path, "hashed-64", DIM)
    return path


def _vectors_sql(name, src, key, text):
    """Unit vectors as the collection stores them: 32-bit floats."""
    return f"""{O.tf_cte(name + "_tf", src, key, text, DIM)},
{name} AS (SELECT {key}, dim, (tf / sqrt(sum(tf * tf) OVER (PARTITION BY {key})))::FLOAT::DOUBLE AS w FROM {name}_tf)"""


_SEARCH_SQL = f"""{O.chunks_cte()},
named AS (SELECT doc_id::VARCHAR || '_' || chunk_no::VARCHAR AS id, chunk, source FROM chunks),
{_vectors_sql("cv", "named", "id", "chunk")},
{_vectors_sql("qv", "benchmark", "item_id", "text")},
cn AS (SELECT id, sqrt(sum(w * w)) AS n FROM cv GROUP BY id),
qn AS (SELECT item_id, sqrt(sum(w * w)) AS n FROM qv GROUP BY item_id),
dots AS (SELECT item_id, id, sum(qv.w * cv.w) AS d FROM qv JOIN cv USING (dim) GROUP BY item_id, id),
scored AS (
  SELECT qn.item_id, cn.id, round(coalesce(d, 0) / (qn.n * cn.n), 6) AS score
  FROM qn CROSS JOIN cn LEFT JOIN dots ON dots.item_id = qn.item_id AND dots.id = cn.id
),
hits AS (
  SELECT * FROM (SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, id))::INTEGER AS rank FROM scored)
  WHERE rank <= {HITS}
)"""


@register("dense_search", f"""
WITH {_SEARCH_SQL}
SELECT item_id, rank, score, id, source, md5(chunk) AS document_md5 FROM hits JOIN named USING (id)
""")
def q_dense_search(spark, sf_dir):
    """V1 + K2 + V4 + S13 + J1: chunks embedded by a registered model into a stored
    collection (twice, one model call per text), then searched; hits carry
    document and metadata."""
    qs = table(spark, sf_dir, "benchmark").select("item_id", "text")
    hits = DC.search(spark, _collection(spark, sf_dir), qs, "item_id", "text", "hashed-64", HITS)
    return hits.select("item_id", "rank", "score", "id", F.col("metadata")["source"].alias("source"), F.md5("document").alias("document_md5"))


@register("dense_answers", f"""
WITH {_SEARCH_SQL},
ctx AS (SELECT item_id, string_agg(chunk, chr(10) || chr(10) ORDER BY rank) AS context FROM hits JOIN named USING (id) GROUP BY item_id),
asked AS (
  SELECT b.item_id, {O.nl(G.RAG_TEMPLATE.split('{context}')[0])} || coalesce(ctx.context, {O.q(G.NO_CONTEXT)})
       || {O.nl(G.RAG_TEMPLATE.split('{context}')[1].split('{question}')[0])} || b.text
       || {O.nl(G.RAG_TEMPLATE.split('{question}')[1])} AS prompt
  FROM benchmark b LEFT JOIN ctx USING (item_id)
)
SELECT item_id, {O.q(PREFIX)} || length(prompt)::VARCHAR || ' ' || md5(prompt) AS answer FROM asked
""")
def q_dense_answers(spark, sf_dir):
    """E2 with K4: the hits' texts in the prompt, answered by a registered text model."""
    qs = table(spark, sf_dir, "benchmark").select("item_id", "text")
    hits = DC.search(spark, _collection(spark, sf_dir), qs, "item_id", "text", "hashed-64", HITS)
    return DC.answers(qs, hits, "item_id", "text", "signed", {"prefix": PREFIX}).select("item_id", "answer")


@register("dense_counts", f"""
WITH {O.chunks_cte()}
SELECT count(*) AS n_rows, count(DISTINCT chunk) AS n_vectors FROM chunks
""")
def q_dense_counts(spark, sf_dir):
    """What two writes of the same corpus leave: one row per chunk, one vector per different text."""
    path = _collection(spark, sf_dir)
    vectors = spark.read.parquet(f"{path}/vectors").agg(F.count("hash").alias("n_vectors"))
    return spark.read.parquet(f"{path}/rows").agg(F.count("id").alias("n_rows")).join(F.broadcast(vectors))
