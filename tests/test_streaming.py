"""Streaming results equal their batch twins, also over several
micro-batches and after a restart from the checkpoint."""

import os
import shutil

from pyspark.sql import functions as F

from ragloom.operators import sessions as S
from ragloom.streaming import assemble as SA
from ragloom.streaming import history as SH
from ragloom.streaming import retrieve as SR
from tests.conftest import SF001

CONV = "conv_id long, turn long, role string, text string"


def _split_files(spark, src_df, out_dir, n_parts, col="turn"):
    """Write the rows as n_parts files, one per turn band, so a stream with
    maxFilesPerTrigger=1 sees them in several micro-batches."""
    os.makedirs(out_dir, exist_ok=True)
    for i in range(n_parts):
        part = src_df.filter(F.col(col) % n_parts == i)
        part.coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/_tmp{i}")
        for f in os.listdir(f"{out_dir}/_tmp{i}"):
            if f.endswith(".parquet"):
                shutil.copy(f"{out_dir}/_tmp{i}/{f}", f"{out_dir}/part{i}.parquet")


def _batch_history(spark, conv):
    ex = S.last_n_exchanges(S.pair_exchanges(S.truncate_at_exit(S.skip_blank_inputs(conv))), 3)
    return ex.select("conv_id", "turn", F.size("history").alias("n_hist"),
                     F.array_join(F.transform("history", lambda x: F.concat(x["q"], F.lit(" -> "), x["a"])), "\n")
                     .alias("history_text"))


def test_stream_history_equals_batch_multi_batch_and_restart(spark, tmpdir_path):
    conv = spark.read.parquet(f"{SF001}/conversations.parquet")
    src = f"{tmpdir_path}/src"
    # turns arrive in order across micro-batches: band i holds turns 2i, 2i+1
    conv2 = conv.withColumn("band", (F.col("turn") / 2).cast("int"))
    os.makedirs(src, exist_ok=True)
    bands = sorted(r[0] for r in conv2.select("band").distinct().collect())
    for b in bands:
        d = f"{tmpdir_path}/_b{b}"
        conv2.filter(F.col("band") == b).drop("band").coalesce(1).write.parquet(d)
        for f in os.listdir(d):
            if f.endswith(".parquet"):
                shutil.copy(f"{d}/{f}", f"{src}/band{b:03d}.parquet")
    out, ck = f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    stream = spark.readStream.schema(CONV).option("maxFilesPerTrigger", 1).parquet(src)
    q = SR.run_to_parquet(SH.stream_history(stream, 3), out, ck)
    assert len(q.recentProgress) >= 2
    # restart from the same checkpoint with nothing new: no duplicate output
    SR.run_to_parquet(SH.stream_history(spark.readStream.schema(CONV).parquet(src), 3), out, ck)
    got = spark.read.parquet(out).select("conv_id", "turn", "n_hist", "history_text")
    want = _batch_history(spark, conv)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_stream_history_exit_and_late(spark, tmpdir_path):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "A"), (1, 2, "user", "quit"), (1, 3, "user", "after"),
            (2, 0, "user", "   "), (2, 1, "user", "b")]
    src = f"{tmpdir_path}/src"
    spark.createDataFrame(rows, CONV).coalesce(1).write.parquet(src)
    out, ck = f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    SR.run_to_parquet(SH.stream_history(spark.readStream.schema(CONV).parquet(src), 3), out, ck)
    late = f"{tmpdir_path}/src2"
    spark.createDataFrame([(2, 0, "user", "late question")], CONV).coalesce(1).write.parquet(late)
    for f in os.listdir(late):
        if f.endswith(".parquet"):
            shutil.copy(f"{late}/{f}", f"{src}/late.parquet")
    SR.run_to_parquet(SH.stream_history(spark.readStream.schema(CONV).parquet(src), 3), out, ck)
    got = sorted((r["conv_id"], r["turn"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, 0), (2, 1)]


def test_stream_assemble_out_of_order(spark, tmpdir_path):
    schema = "conv_id long, turn long, seq int, piece string, done boolean"
    src = f"{tmpdir_path}/src"
    b1 = spark.createDataFrame([(1, 1, 2, "c", True), (1, 1, 0, "a", False), (2, 1, 0, "x", False)], schema)
    b2 = spark.createDataFrame([(1, 1, 1, "b", False), (2, 1, 1, "y", True)], schema)
    for i, b in enumerate((b1, b2)):
        b.coalesce(1).write.parquet(f"{tmpdir_path}/_b{i}")
        for f in os.listdir(f"{tmpdir_path}/_b{i}"):
            if f.endswith(".parquet"):
                os.makedirs(src, exist_ok=True)
                shutil.copy(f"{tmpdir_path}/_b{i}/{f}", f"{src}/b{i}.parquet")
    out, ck = f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    SR.run_to_parquet(SA.stream_assemble(stream), out, ck)
    got = {(r["conv_id"], r["turn"]): r["reply"] for r in spark.read.parquet(out).collect()}
    assert got == {(1, 1): "abc", (2, 1): "xy"}


def test_ingest_stream_is_idempotent(spark, tmpdir_path):
    src = f"{tmpdir_path}/in"
    os.makedirs(src)
    with open(f"{src}/one.txt", "w") as f:
        f.write(" ".join(f"word{i}" for i in range(500)))          # ~4,400 characters
    store, ck = f"{tmpdir_path}/store", f"{tmpdir_path}/ck"
    SR.ingest_stream(spark, src, store, ck).awaitTermination()
    n1 = spark.read.parquet(store).count()
    assert n1 >= 5
    with open(f"{src}/two.TXT", "w") as f:
        f.write("short document")
    with open(f"{src}/bad.txt", "wb") as f:
        f.write(b"\xff\xfe broken")
    SR.ingest_stream(spark, src, store, ck).awaitTermination()
    SR.ingest_stream(spark, src, store, f"{tmpdir_path}/ck2").awaitTermination()   # full replay
    assert spark.read.parquet(store).count() == n1 + 1
    rejects = spark.read.parquet(f"{store}_rejects").select("source").distinct().collect()
    assert [os.path.basename(r[0]) for r in rejects] == ["bad.txt"]


def test_stream_retrieve_multi_batch_equals_batch(spark, tmpdir_path):
    from ragloom.plans import rag
    from ragloom.plans.flows import chat_queries
    from ragloom.operators import retrieve as R
    from ragloom.operators import vectors as V
    conv = spark.read.parquet(f"{SF001}/conversations.parquet")
    src = f"{tmpdir_path}/src"
    os.makedirs(src)
    conv2 = conv.withColumn("band", (F.col("turn") / 2).cast("int"))
    for b in sorted(r[0] for r in conv2.select("band").distinct().collect()):
        d = f"{tmpdir_path}/_b{b}"
        conv2.filter(F.col("band") == b).drop("band").coalesce(1).write.parquet(d)
        for f in os.listdir(d):
            if f.endswith(".parquet"):
                shutil.copy(f"{d}/{f}", f"{src}/band{b:03d}.parquet")
    _, cvec, idf = rag.corpus_vectors(spark, SF001)
    stream = spark.readStream.schema(CONV).option("maxFilesPerTrigger", 1).parquet(src)
    out, ck = f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    q = SR.stream_retrieve(SH.stream_history(stream, 3), cvec, idf, ["conv_id", "turn"], rag.CORPUS_KEYS, out, ck)
    q.awaitTermination()
    assert len(q.recentProgress) >= 2
    got = spark.read.parquet(out).select("conv_id", "turn", "doc_id", "chunk_no", "score", "rank")
    qv = V.embed_queries(chat_queries(conv, 3), ["conv_id", "turn"], "query", idf=idf)
    want = R.knn_sparse(qv, cvec, ["conv_id", "turn"], rag.CORPUS_KEYS, 4)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_retrieval_quality_floor(spark):
    """Gold documents (literal containment) are found: a floor under the
    measured values (all 20 at rank 1 at sf0.01; 136/139 at sf0.1)."""
    import __spark_entry__ as E
    from tests.conftest import SF01
    r = E.queries()["retrieval_recall"](spark, SF01).first()
    assert r["n_questions"] == 20
    assert r["recall_at_1"] >= 0.9 and r["recall_at_4"] >= 0.95
