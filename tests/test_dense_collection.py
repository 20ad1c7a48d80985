"""Dense collection: one model call per text, dimension check, hits with documents, answers."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ragloom.functions import infer as K
from ragloom.plans import dense as DC


def _counting(folder):
    """A model that leaves a file for every text it embeds."""
    def factory():
        import uuid
        base = K.hashed_dense_embedder(16)

        def fn(texts):
            for _ in texts:
                open(f"{folder}/{uuid.uuid4().hex}", "w").close()
            return base(texts)
        return fn
    return factory


def _rows(spark, rows):
    return spark.createDataFrame(rows, "id string, document string").withColumn("metadata", F.create_map(F.lit("n"), F.col("id")))


def test_one_call_per_text_and_search(spark, tmpdir_path):
    calls = f"{tmpdir_path}/calls"
    os.makedirs(calls)
    K.register_embedder("counting", _counting(calls))
    path = f"{tmpdir_path}/coll"
    first = _rows(spark, [("a", "red fox"), ("b", "red fox"), ("c", "blue sea"), ("d", ""), ("e", None)])
    assert DC.write(spark, first, path, "counting", 16).count() == 5
    assert len(os.listdir(calls)) == 3                     # null and empty are one text
    assert DC.write(spark, first, path, "counting", 16).count() == 0
    assert DC.write(spark, _rows(spark, [("f", "blue sea"), ("g", "green hill")]), path, "counting", 16).count() == 2
    assert len(os.listdir(calls)) == 4
    qs = spark.createDataFrame([(1, "the red fox"), (2, "sea")], "qid long, text string")
    hits = DC.search(spark, path, qs, "qid", "text", "counting", 3).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["id"]) for r in hits if r["rank"] <= 2] == [(1, "a"), (1, "b"), (2, "c"), (2, "f")]
    assert hits[0]["document"] == "red fox" and hits[0]["metadata"] == {"n": "a"}


def test_dimension_mismatch_fails_the_write(spark, tmpdir_path):
    K.register_embedder("sixteen", lambda: K.hashed_dense_embedder(16))
    path = f"{tmpdir_path}/coll"
    with pytest.raises(Exception, match="dimension"):
        DC.write(spark, _rows(spark, [("a", "x")]), path, "sixteen", 17)
    assert spark.read.parquet(f"{path}/vectors").count() == 0


def test_registry_and_generation(spark, tmpdir_path):
    with pytest.raises(KeyError):
        K.embedder("nobody")
    K.register_generator("echo", lambda: lambda prompts, options: [f"{options.get('t')}:{p}" for p in prompts])
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "i long, p string")
    got = {r["i"]: r["r"] for r in K.generate_named(df, "p", "echo", "r", {"t": 0}).collect()}
    assert got == {1: "0:a", 2: "0:", 3: "0:"}
    got = K.batch_infer(df, "p", lambda prompts, options: [p.upper() for p in prompts]).where("i = 1").first()["response"]
    assert got == "A"
    with pytest.raises(Exception, match="replies"):
        K.batch_infer(df, "p", lambda prompts, options: []).collect()
    assert K.batch_infer(df.limit(0), "p", lambda prompts, options: []).count() == 0


def test_answers_without_hits(spark):
    K.register_generator("size", lambda: lambda prompts, options: [str(len(p)) for p in prompts])
    qs = spark.createDataFrame([(1, "why?")], "qid long, text string")
    none = spark.createDataFrame([], "qid long, rank int, document string")
    r = DC.answers(qs, none, "qid", "text", "size").first()
    assert r["n_hits"] == 0 and "No relevant docs" in r["prompt"] and r["answer"] == str(len(r["prompt"]))


def test_word_is_hashed_once(monkeypatch):
    import hashlib
    asked, md5 = [], hashlib.md5
    monkeypatch.setattr(hashlib, "md5", lambda b: asked.append(b) or md5(b))
    model = K.hashed_dense_embedder(8)
    got = model(["red fox red", "Fox", ""]) + model(["red"])
    assert sorted(asked) == [b"fox", b"red"]
    assert got[2] == [0.0] * 8 and sum(x * x for x in got[0]) == pytest.approx(1) and sorted(got[3])[-1] == 1


def test_documents_of_other_texts_are_not_moved(spark, tmpdir_path):
    K.register_embedder("sixteen", lambda: K.hashed_dense_embedder(16))
    path = f"{tmpdir_path}/coll"
    DC.write(spark, _rows(spark, [(f"r{i}", f"text {i % 7}") for i in range(40)]), path, "sixteen", 16)
    qs = spark.createDataFrame([(1, "text 3")], "qid long, text string")
    hits = DC.search(spark, path, qs, "qid", "text", "sixteen", 2)
    assert [(r["id"], r["document"]) for r in hits.orderBy("rank").collect()] == [("r10", "text 3"), ("r17", "text 3")]
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan  # rows meet the hits before they are ranked within their text
