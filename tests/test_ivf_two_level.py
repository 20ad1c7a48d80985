"""J3 in two levels: every vector indexed, exact at all cells, growth without training."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ragloom.operators import ivf as IVF
from ragloom.operators import retrieve as R


def _clusters(spark, n=600, dim=8, seed=5):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, dim)) * 4
    rows = [(i, [float(x) for x in centers[i % 12] + rng.normal(size=dim) * 0.3]) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None)], "id long, v array<double>")


def test_two_levels(spark, tmpdir_path):
    df = _clusters(spark)
    path = f"{tmpdir_path}/ivf"
    IVF.build(df.where("id < 500 OR v IS NULL"), "id", "v", path, per_cell=25)
    IVF.add(df.where("id >= 500"), "id", "v", path)
    stored = spark.read.parquet(f"{path}/vectors")
    assert sorted(r["id"] for r in stored.collect()) == list(range(600))
    fine, coarse = spark.read.parquet(f"{path}/fine"), spark.read.parquet(f"{path}/coarse")
    cells, wide = fine.count(), coarse.count()
    assert wide >= 4 and cells >= 15
    q = df.where("id % 20 = 0").withColumnRenamed("id", "qid")
    exact = R.knn_dense(q, df, "qid", "id", "v", k=4)
    whole = IVF.search(q, path, "qid", "id", "v", 4, cells, wide)
    assert whole.exceptAll(exact.select(whole.columns)).count() == 0 and whole.count() == exact.count()
    some = IVF.search(q, path, "qid", "id", "v", 4, max(cells // 3, 1), wide)
    found = some.join(exact.select("qid", "id"), ["qid", "id"], "left_semi").count()
    assert found >= 0.9 * exact.count()                    # clustered vectors: near cells hold near vectors
    near = stored.join(fine.select(F.col("c").alias("cell"), F.col("cell").alias("own")), "cell")
    assert near.where("own <> coarse").count() == 0        # cells lie in their coarse cell


def test_fewer_vectors_than_cells(spark, tmpdir_path):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], "id long, v array<double>")
    IVF.build(df, "id", "v", f"{tmpdir_path}/i", per_cell=1)
    got = IVF.search(df.withColumnRenamed("id", "qid"), f"{tmpdir_path}/i", "qid", "id", "v", 2, 10, 10)
    assert got.where("qid = 3 AND rank = 1").first()["id"] == 3 and got.count() == 6
