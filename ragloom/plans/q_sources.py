"""Registered dataset / store-shaped queries: question-support dataset, ids and
batches, insert-absent result set, page concatenation, union of sources,
metadata sanitising, recursive chunking."""

from __future__ import annotations

from pyspark.sql import functions as F

from ragloom.operators import chunk as C
from ragloom.operators import metadata as M
from ragloom.operators import retrieve as R
from ragloom.operators import rows as W
from ragloom.operators import sessions as S
from ragloom.operators import vectors as V
from ragloom.plans import oracle as O
from ragloom.plans import rag
from ragloom.plans.catalog import register
from ragloom.plans.sizing import broadcast_if_small
from ragloom.session import table
from ragloom.sources import store as ST


def qa(spark, sf_dir):
    """The question/support dataset: every benchmark item as a question; its
    support is the (lowest-id) document containing it, or '' when none does."""
    gold = rag.gold_pairs(spark, sf_dir).groupBy("item_id").agg(F.min("doc_id").alias("doc_id"))
    gold, _ = broadcast_if_small(gold)          # one row per question at most
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sup = docs.join(gold, "doc_id").select("item_id", F.col("text").alias("support"))
    b = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("question"))
    return b.join(sup, "item_id", "left").withColumn("support", F.coalesce("support", F.lit("")))


_QA_SQL = f"""{O.gold_cte()},
qa AS (
  SELECT b.item_id, b.text AS question, coalesce(d.text, '') AS support
  FROM benchmark b LEFT JOIN (SELECT item_id, min(doc_id) AS doc_id FROM gold GROUP BY item_id) g USING (item_id)
  LEFT JOIN documents d ON d.doc_id = g.doc_id
)"""


@register("qa_support_counts", f"""
WITH {_QA_SQL}
SELECT count(*) AS n_questions, count(*) FILTER (WHERE support <> '') AS n_with_support FROM qa
""")
def q_qa_counts(spark, sf_dir):
    """S9 + P1 + A1: questions in the dataset and questions with a (non-empty) support."""
    d = qa(spark, sf_dir)
    n_all = d.select(F.count(F.lit(1))).scalar()
    return S.non_empty(d, "support").agg(F.count(F.lit(1)).alias("n_with_support")).select(
        n_all.alias("n_questions"), "n_with_support")


@register("support_ids_batches", """
SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::VARCHAR AS id,
       ((row_number() OVER (ORDER BY doc_id) - 1) // 1000)::BIGINT AS batch_id, 'support' AS meta_type
FROM documents WHERE text <> ''
""")
def q_support_ids(spark, sf_dir):
    """P1 + P5 + P6 + S15: supports numbered 0.. in dataset order as string ids,
    insert batches of 1000, constant metadata {type: support}."""
    d = S.non_empty(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    o = W.with_ordinal(d.select("doc_id"), ["doc_id"], "ordinal")
    meta = W.constant_metadata(type="support")
    return o.select("doc_id", F.col("ordinal").cast("string").alias("id"),
                    F.floor(F.col("ordinal") / 1000).cast("long").alias("batch_id"),
                    meta["type"].alias("meta_type"))


@register("first_ten_questions", "SELECT item_id, text FROM benchmark ORDER BY item_id LIMIT 10")
def q_first_ten(spark, sf_dir):
    """The first ten questions in dataset order (the limit is the operator)."""
    return table(spark, sf_dir, "benchmark").select("item_id", "text").orderBy("item_id").limit(10)


_DOC_SEARCH_SQL = f"""
{O.tf_cte("dtf", "(SELECT doc_id, text FROM documents WHERE text <> '')", "doc_id", "text")},
didf AS (SELECT dim, ln((SELECT count(DISTINCT doc_id) FROM dtf)::DOUBLE / count(*)) AS idf FROM dtf GROUP BY dim),
dw AS (SELECT doc_id, dim, tf * idf AS w FROM dtf JOIN didf USING (dim) WHERE idf > 0),
dvec AS (SELECT doc_id, dim, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM dw),
first10 AS (SELECT item_id, text FROM benchmark ORDER BY item_id LIMIT 10),
{O.tf_cte("btf", "first10", "item_id", "text")},
bw AS (SELECT item_id, dim, tf * idf AS w FROM btf JOIN didf USING (dim) WHERE idf > 0),
bvec AS (SELECT item_id, dim, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS w FROM bw),
sc AS (SELECT bvec.item_id, dvec.doc_id, round(sum(bvec.w * dvec.w), 6) AS score FROM bvec JOIN dvec USING (dim) GROUP BY ALL),
top1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rk FROM sc) WHERE rk = 1)"""


@register("qa_top1_support", f"""
WITH {_DOC_SEARCH_SQL}
SELECT f.item_id, t.doc_id AS support_doc, t.score FROM first10 f LEFT JOIN top1 t USING (item_id)
""")
def q_qa_top1(spark, sf_dir):
    """T2 + J2 + J5: the first ten questions, each paired with its top-1 support
    from the whole-document collection (supports are embedded unchunked)."""
    docs = S.non_empty(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    tf = V.hashed_tf(docs.repartition(rag.corpus_partitions(spark), "doc_id"), ["doc_id"], "text")
    idf = V.idf_table(tf, ["doc_id"])
    dvec = V.apply_idf(tf, idf, ["doc_id"])
    first10 = table(spark, sf_dir, "benchmark").select("item_id", "text").orderBy("item_id").limit(10)
    qvec = V.embed_queries(first10, ["item_id"], "text", idf=idf)
    hits = R.knn_sparse(qvec, dvec, ["item_id"], ["doc_id"], k=1)
    return R.positional_join(first10.select("item_id"), hits.withColumnRenamed("doc_id", "support_doc"),
                             "item_id", ["support_doc", "score"])


@register("insert_absent_ids", """
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def q_insert_absent(spark, sf_dir):
    """J6 / S13 on a store bucketed by id: the labels' ids are stored, then the
    documents' ids inserted; the rows that this adds."""
    from ragloom.streaming.retrieve import scratch_path
    path, n = scratch_path(spark, "ids"), rag.corpus_partitions(spark)
    for name in ("labels", "documents"):
        added = ST.insert_absent(spark, table(spark, sf_dir, name).select("doc_id"), path, "doc_id", n)
    return added


@register("reassemble_documents", f"""
WITH {O.chunks_cte()},
mx AS (SELECT doc_id, max(chunk_no) AS last_no FROM chunks GROUP BY doc_id),
re AS (SELECT c.doc_id, string_agg(CASE WHEN c.chunk_no = mx.last_no THEN c.chunk ELSE substr(c.chunk, 1, 800) END, ''
                                   ORDER BY c.chunk_no) AS text
       FROM chunks c JOIN mx USING (doc_id) GROUP BY c.doc_id)
SELECT d.doc_id, length(re.text)::INTEGER AS n_chars, re.text = d.text AS same_text
FROM documents d JOIN re USING (doc_id)
""")
def q_reassemble(spark, sf_dir):
    """C4: concatenate page-like pieces in order — each chunk's non-overlapping
    head (the last chunk whole) — and check the document text comes back."""
    ch = rag.chunks(spark, sf_dir)
    from pyspark.sql import Window
    last = F.max("chunk_no").over(Window.partitionBy("doc_id"))
    pieces = ch.withColumn("piece", F.when(F.col("chunk_no") == last, F.col("chunk"))
                           .otherwise(F.substring("chunk", 1, C.DEFAULT_CHUNK_SIZE - C.DEFAULT_CHUNK_OVERLAP)))
    re = C.concat_pages(pieces.select("doc_id", F.col("chunk_no").alias("page"), F.col("piece").alias("text")))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("orig"))
    return re.join(docs, "doc_id").select("doc_id", F.length("text").alias("n_chars"),
                                          (F.col("text") == F.col("orig")).alias("same_text"))


@register("union_sources", """
SELECT origin, count(*) AS n_docs, sum(length(text))::BIGINT AS n_chars FROM (
  SELECT 'documents' AS origin, text FROM documents UNION ALL SELECT 'benchmark' AS origin, text FROM benchmark)
GROUP BY origin
""")
def q_union(spark, sf_dir):
    """Documents of two sources (different schemas) in one collection."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("origin", F.lit("documents"))
    b = table(spark, sf_dir, "benchmark").select("item_id", "text").withColumn("origin", F.lit("benchmark"))
    u = d.unionByName(b, allowMissingColumns=True)
    return u.groupBy("origin").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.length("text")).cast("long").alias("n_chars"))


def _metadata_json():
    return F.to_json(F.struct(
        F.col("source"), F.col("lang"), F.col("n_chars"), F.col("quality"),
        F.when(F.col("n_chars") > 1000, F.array(F.col("lang"))).otherwise(F.array().cast("array<string>")).alias("tags"),
        F.struct(F.col("n_chars").alias("len")).alias("nested"),
        F.lit(None).cast("string").alias("empty")), {"ignoreNullFields": "false"})


@register("sanitize_metadata", """
SELECT d.doc_id,
  'lang=' || d.lang || ';n_chars=' || d.n_chars::VARCHAR
  || CASE WHEN l.quality IS NOT NULL THEN ';quality=' || l.quality::VARCHAR ELSE '' END
  || ';source=' || d.source
  || CASE WHEN d.n_chars > 1000 THEN ';tags=[''' || d.lang || ''']' ELSE '' END AS kept
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def q_sanitize(spark, sf_dir):
    """Free-form document metadata (strings, numbers, nulls, lists, nested
    objects) reduced to the scalar entries a vector store accepts."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    meta = d.join(lab, "doc_id", "left").select("doc_id", F.parse_json(_metadata_json()).alias("meta"))
    kept = M.sanitize_metadata("meta")
    entries = F.array_sort(F.map_entries(kept))
    return meta.select("doc_id", F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])),
                                              ";").alias("kept"))


@register("chunk_recursive")
def q_chunk_recursive(spark, sf_dir):
    """Recursive-separator chunks (1000/200) of every document; invariants
    are tested in pytest (no SQL twin)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ch = C.chunk_recursive(docs, "text")
    return ch.select("doc_id", "chunk_no", "chunk_start", F.length("chunk").alias("chunk_len"))


@register("chunk_recursive_checks", """
SELECT doc_id, true AS cut_from_text, true AS short_enough, true AS in_order, true AS overlap_fits,
       length(regexp_replace(text, '[ \\t\\n\\r]', '', 'g'))::BIGINT AS n_covered, length(text) <= 1000 AS one_chunk_at_most
FROM documents WHERE length(regexp_replace(text, '[ \\t\\n\\r]', '', 'g')) > 0
""")
def q_chunk_recursive_checks(spark, sf_dir):
    """C2 against its contract, document by document: each chunk is the text at
    its place and at most 1000 long, places ascend, what two chunks share is at
    most 200 long, and every visible character is in a chunk."""
    from pyspark.sql import Window
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ch = C.chunk_recursive(docs, "text").withColumn("end", F.col("chunk_start") + F.length("chunk"))
    before = Window.partitionBy("doc_id").orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    last = Window.partitionBy("doc_id").orderBy("chunk_no")
    seen = F.coalesce(F.max("end").over(before), F.lit(0))
    ch = ch.withColumns({"seen": seen, "ahead": F.coalesce(F.lag("chunk_start").over(last), F.lit(0))})
    fresh = F.substring("text", F.greatest("seen", "chunk_start") + 1, F.greatest(F.col("end") - F.greatest("seen", "chunk_start"), F.lit(0)))
    visible = F.length(F.regexp_replace(fresh, "[ \\t\\n\\r]", ""))
    return ch.groupBy("doc_id").agg(
        F.bool_and(F.substring("text", F.col("chunk_start") + 1, F.length("chunk")) == F.col("chunk")).alias("cut_from_text"),
        F.bool_and(F.length("chunk") <= C.DEFAULT_CHUNK_SIZE).alias("short_enough"),
        F.bool_and(F.col("chunk_start") >= F.col("ahead")).alias("in_order"),
        F.bool_and(F.col("seen") - F.col("chunk_start") <= C.DEFAULT_CHUNK_OVERLAP).alias("overlap_fits"),
        F.sum(visible).alias("n_covered"),
        ((F.max(F.length("text")) <= C.DEFAULT_CHUNK_SIZE) & (F.count(F.lit(1)) == 1)).alias("one_chunk_at_most"))


@register("csv_roundtrip", f"""
SELECT source, count(*) AS n_docs,
       sum(length('doc_id: ' || doc_id::VARCHAR || chr(10) || 'lang: ' || lang || chr(10) || 'text: '
                  || regexp_replace(text, '{S.STRIP_PATTERN}', '', 'g')))::BIGINT AS n_chars
FROM documents GROUP BY source
""")
def q_csv_roundtrip(spark, sf_dir):
    """S2 + S6 over files Spark derives from `documents`: the table is written
    as CSV files (one folder per source, RFC 4180 quoting) under the
    checkpoint folder, walked recursively, and read back one document per
    row (`column: value` lines, values stripped) — counts and characters per
    source folder."""
    from ragloom.sources import files as FS
    from ragloom.streaming.retrieve import scratch_path
    root = scratch_path(spark, "csv-docs")
    (table(spark, sf_dir, "documents").select("doc_id", "lang", "text", "source")
        .write.option("header", "true").option("escape", '"').partitionBy("source").csv(root))
    docs = FS.scan_csv_docs(spark, root).filter(F.col("error").isNull())
    src = F.regexp_extract("source", r"source=([^/]+)/", 1)
    return docs.groupBy(src.alias("source")).agg(F.count(F.lit(1)).alias("n_docs"),
                                                 F.sum(F.length("text")).cast("long").alias("n_chars"))
