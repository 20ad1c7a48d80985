"""S13 / J6 on a store bucketed by id."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ragloom.sources import store as ST


def _rows(spark, ids):
    return spark.createDataFrame([(i, f"t{i}") for i in ids], "id string, document string")


@pytest.mark.parametrize("buckets", [None, 4])
def test_insert_absent(spark, tmpdir_path, buckets):
    path = f"{tmpdir_path}/s/store"
    assert ST.insert_absent(spark, _rows(spark, "abcde"), path, buckets=buckets).count() == 5
    added = ST.insert_absent(spark, _rows(spark, "cdefg"), path, buckets=buckets)
    assert sorted(r["id"] for r in added.collect()) == ["f", "g"]
    assert ST.insert_absent(spark, _rows(spark, "abg"), path, buckets=buckets).count() == 0
    assert ST.insert_absent(spark, _rows(spark, ""), path, buckets=buckets).count() == 0
    with pytest.raises(Exception, match="duplicate id"):
        ST.insert_absent(spark, _rows(spark, "xyx"), path, buckets=buckets)
    stored = spark.read.parquet(path)
    assert sorted(r["id"] for r in stored.collect()) == list("abcdefg") and stored.where("document <> concat('t', id)").count() == 0
    assert os.listdir(f"{tmpdir_path}/s") == ["store"]                       # nothing staged beside it


def test_stored_side_is_not_shuffled(spark, tmpdir_path):
    path = f"{tmpdir_path}/store"
    ST.insert_absent(spark, _rows(spark, "abcde"), path, buckets=4)
    stored = spark.table(ST.bucketed(spark, path, _rows(spark, "").schema, "id", 4)).select("id")
    new = _rows(spark, "def").repartition(4, "id")
    plan = new.hint("merge").join(stored, "id", "left_anti")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("FileScan") - 400:plan.index("FileScan")]
    assert "Exchange" not in below and "SelectedBucketsCount: 4 out of 4" in plan


def test_new_rows_stay_in_place(spark, tmpdir_path):
    path = f"{tmpdir_path}/store"
    rows = spark.range(0, 300, 1, 3).withColumn("document", F.col("id").cast("string"))
    ST.insert_absent(spark, rows, path)
    ST.insert_absent(spark, spark.range(200, 400, 1, 2).withColumn("document", F.col("id").cast("string")), path)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("id").alias("n")).collect()
    assert sum(r["n"] for r in files) == 400 and all(r["b"] - r["a"] + 1 == r["n"] for r in files)  # not dealt out by id


@pytest.mark.parametrize("most", [0, 10])
def test_rows_without_an_id_are_new(spark, tmpdir_path, monkeypatch, most):
    monkeypatch.setattr(ST, "MAX_BROADCAST_ROWS", most)
    path = f"{tmpdir_path}/store"
    rows = spark.createDataFrame([("a", "x"), (None, "y"), (None, "z")], "id string, document string")
    assert ST.insert_absent(spark, rows, path).count() == 3
    assert ST.insert_absent(spark, rows, path).count() == 2
    assert spark.read.parquet(path).count() == 5
