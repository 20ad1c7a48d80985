"""S1-S15 file sources and store, P4 metadata, ordinals."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ragloom.operators import metadata as M
from ragloom.operators import rows as W
from ragloom.sources import files as FS
from ragloom.sources import store as ST

ARTICLE = ("La inflación porteña de marzo fue del 3,2%.\n\n"
           "Los alimentos subieron más que el promedio.\n\n  - pan\n  - leche\n")


def _tree(root):
    os.makedirs(f"{root}/sub/deeper", exist_ok=True)
    with open(f"{root}/a.txt", "w", encoding="utf-8") as f:
        f.write(ARTICLE)
    with open(f"{root}/sub/B.TXT", "w", encoding="utf-8") as f:
        f.write("upper case suffix")
    with open(f"{root}/sub/notes.md", "w") as f:
        f.write("# Title\n\nSome **bold** and [a link](http://x.y).\n\n- item one\n")
    with open(f"{root}/sub/deeper/doc.adoc", "w") as f:
        f.write("= Doc Title\n:author: me\n\n== Section\n\nText with *strong* words.\n----\ncode\n----\n")
    with open(f"{root}/sub/data.csv", "w") as f:
        f.write('name,age\n"Olga",22\n"Alonso, Jr",23\n')
    with open(f"{root}/sub/deeper/x.pdf", "wb") as f:
        f.write(b"%PDF fake page one\x0cpage two")
    with open(f"{root}/broken.pdf", "wb") as f:
        f.write(b"garbage")
    with open(f"{root}/skip.json", "w") as f:
        f.write("{}")
    with open(f"{root}/bad.txt", "wb") as f:
        f.write(b"\xff\xfe\xfa broken utf8")


def toy_pdf(data: bytes, path: str):
    if not data.startswith(b"%PDF"):
        raise ValueError("not a pdf")
    return data[5:].decode().split("\x0c")


def test_load_directory_routes_and_quarantines(spark, tmpdir_path):
    _tree(tmpdir_path)
    docs, rejects = FS.load_directory(spark, tmpdir_path, {".pdf": toy_pdf})
    d = docs.collect()
    names = sorted(os.path.basename(r["source"]) for r in d)
    assert names == ["B.TXT", "a.txt", "data.csv", "data.csv", "doc.adoc", "notes.md", "x.pdf", "x.pdf"]
    by = {os.path.basename(r["source"]) + str(r["page"]): r["text"] for r in d}
    assert by["a.txt0"] == ARTICLE
    assert by["data.csv0"] == "name: Olga\nage: 22" and by["data.csv1"] == "name: Alonso, Jr\nage: 23"
    assert "Title" in by["notes.md0"] and "**" not in by["notes.md0"] and "a link" in by["notes.md0"]
    assert "Doc Title" in by["doc.adoc0"] and ":author:" not in by["doc.adoc0"] and "*" not in by["doc.adoc0"]
    assert by["x.pdf0"] == "fake page one" and by["x.pdf1"] == "page two"
    rej = {os.path.basename(r["source"]): r["error"] for r in rejects.collect()}
    assert set(rej) == {"broken.pdf", "bad.txt"}
    assert "not a pdf" in rej["broken.pdf"]


def test_flat_dir_is_not_recursive(spark, tmpdir_path):
    _tree(tmpdir_path)
    with open(f"{tmpdir_path}/top.pdf", "wb") as f:
        f.write(b"%PDF top")
    with open(f"{tmpdir_path}/UPPER.PDF", "wb") as f:
        f.write(b"%PDF upper")
    docs = FS.scan_flat_dir(spark, tmpdir_path, toy_pdf, ".pdf").filter("error is null")
    assert sorted(os.path.basename(r["source"]) for r in docs.collect()) == ["top.pdf"]


def test_suffix(spark):
    df = spark.createDataFrame([("a/b.TXT",), ("a/b",), ("a.d/b.tar.gz",)], "p string")
    assert [r[0] for r in df.select(FS.suffix("p")).collect()] == [".txt", "", ".gz"]


def test_store_lifecycle(spark, tmpdir_path):
    path = f"{tmpdir_path}/store"
    assert ST.open_store(spark, path) is None
    ST.open_store(spark, path, "id string, document string", create=True)
    batch = spark.createDataFrame([("a_0", "x"), ("a_1", "y")], "id string, document string")
    added = ST.insert_absent(spark, batch, path)
    assert added.count() == 2
    again = spark.createDataFrame([("a_1", "CHANGED"), ("a_2", "z")], "id string, document string")
    assert ST.insert_absent(spark, again, path).count() == 1
    stored = {r["id"]: r["document"] for r in spark.read.parquet(path).collect()}
    assert stored == {"a_0": "x", "a_1": "y", "a_2": "z"}
    dup = spark.createDataFrame([("d", "1"), ("d", "2")], "id string, document string")
    with pytest.raises(Exception):
        ST.insert_absent(spark, dup, path)
    ST.append(batch.drop("id"), path)
    ST.append(batch.drop("id"), path)
    assert spark.read.parquet(path).count() == 3 + 4
    new_path = ST.overwrite(spark, batch, path, swap=False)
    assert new_path != path and spark.read.parquet(new_path).count() == 2
    assert ST.overwrite(spark, batch, path) == path          # swapped in place
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == ["a_0", "a_1"]


def test_batched_write(spark, tmpdir_path):
    df = spark.range(2500).withColumnRenamed("id", "k").repartition(3)
    path = f"{tmpdir_path}/batches"
    ST.batched_write(df, path, "k", batch=1000)
    out = spark.read.parquet(path)
    counts = {r["batch_id"]: r["count"] for r in out.groupBy("batch_id").count().collect()}
    assert counts == {0: 1000, 1: 1000, 2: 500}
    assert out.filter(F.col("ordinal") != F.col("k")).count() == 0
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    for f in files:
        assert spark.read.parquet(f"{path}/{f}").count() <= 1000


def test_ordinal_matches_row_number(spark):
    df = spark.range(0, 5000, 3).withColumnRenamed("id", "k").repartition(6)
    o = W.with_ordinal(df, ["k"]).collect()
    assert sorted((r["ordinal"], r["k"]) for r in o) == [(i, 3 * i) for i in range(len(o))]


def test_sanitize_metadata(spark):
    meta = ('{"s": "{not json}", "i": 3, "f": 1.5, "b": true, "n": null, "o": {"x": 1}, '
            '"l": ["a", 2], "e": []}')
    df = spark.createDataFrame([(meta,), ("[1,2]",)], "m string")
    out = df.select(M.sanitize_metadata(F.parse_json("m")).alias("k")).collect()
    assert out[0]["k"] == {"s": "{not json}", "i": "3", "f": "1.5", "b": "true", "l": "['a', 2]"}
    assert out[1]["k"] == {}


def test_constant_metadata_and_ids(spark):
    df = spark.createDataFrame([("p.pdf", 0)], "path string, i int")
    r = df.select(W.make_id("path", "i").alias("id"), W.constant_metadata(type="support").alias("m")).first()
    assert r["id"] == "p.pdf_0" and r["m"] == {"type": "support"}


def test_collection_write_once_search_many(spark, tmpdir_path):
    from ragloom.plans import collection as COL
    from ragloom.plans import rag
    from tests.conftest import SF001
    path = f"{tmpdir_path}/coll"
    rows = COL.collection_rows(rag.chunks(spark, SF001))
    n = rows.count()
    assert COL.write(spark, rows, path).count() == n
    assert COL.write(spark, rows, path).count() == 0          # replay adds nothing
    assert spark.read.parquet(path).count() == n
    qs = spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text")
    stored = COL.search(spark, path, qs, ["item_id"], "text", k=4)
    direct = rag.search(spark, SF001, k=4)
    assert stored.exceptAll(direct).count() == 0 and direct.exceptAll(stored).count() == 0


def test_embed_directory_flow(spark, tmpdir_path):
    from ragloom.plans.flows import embed_directory
    root = f"{tmpdir_path}/tree"
    os.makedirs(root)
    _tree(root)
    store = f"{tmpdir_path}/store"
    first = embed_directory(spark, root, store, {".pdf": toy_pdf}, size=40, overlap=10)
    assert first["rejects"] == 2 and first["documents"] == 8
    assert first["added"] == first["chunks"] > 0
    again = embed_directory(spark, root, store, {".pdf": toy_pdf}, size=40, overlap=10)
    assert again["added"] == 0                                   # S13: nothing twice
    fresh = embed_directory(spark, root, store, {".pdf": toy_pdf}, size=40, overlap=10, clear=True)
    assert fresh["store"] == store and fresh["added"] == first["chunks"]
    assert spark.read.parquet(store).count() == first["chunks"]
    row = spark.read.parquet(store).filter(F.col("doc_id").endswith("a.txt")).orderBy("chunk_no").first()
    assert row["metadata"]["source"].endswith("a.txt") and len(row["dims"]) == len(row["tfs"]) > 0


def test_group_ordinal_matches_row_number(spark):
    from pyspark.sql import Window
    # one hot group with most rows plus many small ones
    df = spark.range(0, 6000).select((F.when(F.col("id") < 4000, F.lit(0)).otherwise(F.col("id") % 37)).alias("g"),
                                     (F.col("id") * 7919 % 6001).alias("o")).repartition(5)
    got = W.with_group_ordinal(df, ["g"], ["o"]).select("g", "o", "ordinal")
    want = df.select("g", "o", (F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1).cast("long").alias("ordinal"))
    assert got.count() == 6000
    assert got.exceptAll(want).count() == 0


def test_ordinals_at_scale_many_partitions(spark):
    """Large enough that the range sort samples and cuts many partitions: the
    offsets must come from the same partitioning as the positions."""
    from pyspark.sql import Window
    n = 300_000
    df = spark.range(0, n, numPartitions=16).select(
        (F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 101)).alias("g"),
        ((F.col("id") * 2654435761) % 1000003).alias("o"), F.col("id").alias("u"))
    got = W.with_group_ordinal(df, ["g"], ["o", "u"]).select("g", "u", "ordinal")
    want = df.select("g", "u", (F.row_number().over(Window.partitionBy("g").orderBy("o", "u")) - 1)
                     .cast("long").alias("ordinal"))
    assert got.count() == n and got.exceptAll(want).count() == 0
    glob = W.with_ordinal(df, ["o", "u"]).select("u", "ordinal")
    want_g = df.select("u", (F.row_number().over(Window.orderBy("o", "u")) - 1).cast("long").alias("ordinal"))
    assert glob.count() == n and glob.exceptAll(want_g).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6),
                          st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(lambda x: round(x, 3) + 0.0),
                          st.text(alphabet=st.sampled_from(list("ab '\"\\\n\t")), max_size=6)),
                min_size=1, max_size=5))
def test_list_text_matches_python_str(spark_session_for_hypothesis, items):
    import json
    df = spark_session_for_hypothesis.createDataFrame([(json.dumps({"l": items}),)], "m string")
    got = df.select(M.sanitize_metadata(F.parse_json("m"))["l"]).first()[0]
    assert got == str(items)
