"""An approximate index of two levels that grows with its vectors.

About `per_cell` vectors make a cell, and about as many coarse cells as a coarse
cell has cells cover them, so both numbers follow the data and finding a cell
costs the root of their number. Centroids are tables, never plan literals or
driver arrays: the nearest coarse cells, the nearest cells within them, and the
nearest vectors within those are three times the same join (block products
within cells). New vectors are placed by the stored centroids; nothing is
trained again.

The centroids are fitted on a sample: SAMPLE_PER_CELL vectors a cell on average,
and at most SAMPLE_PER_COARSE of a coarse cell, chosen by the hash of the key.
Every vector is indexed. Vectors have one length; null ones are not indexed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.operators import retrieve as R

PER_CELL = 256
SAMPLE_PER_CELL = 32
SAMPLE_PER_COARSE = 20_000
ROUNDS = 12


def _lloyd(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids of k groups of the rows; fewer if there are fewer different rows."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        near = np.argmin((c * c).sum(1)[None, :] - 2 * x @ c.T, axis=1)
        size = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
    return c


def _nearest(rows: DataFrame, key: str, vec_col: str, centroids: DataFrame, within: bool, k: int = 1) -> DataFrame:
    """(key, c): the k nearest centroids `(c, centroid, cell)` of each row, among those of the row's `cell` if `within`."""
    asked = rows.select(key, F.col(vec_col).alias("__qv"), F.col("cell") if within else F.lit(0).alias("cell"))
    held = centroids.select("c", "centroid", F.col("cell") if within else F.lit(0).alias("cell"))
    return R._block_products(asked, held, key, "c", "centroid", k, "l2", 1024).select(key, "c")


def build(corpus: DataFrame, c_key: str, vec_col: str, path: str, per_cell: int = PER_CELL, seed: int = 7) -> None:
    """Train the cells of `corpus (c_key, vec_col)` and write the index under `path`:
    `coarse (c, centroid)`, `fine (c, centroid, cell)` with the coarse cell of each
    cell, and `vectors`, in folders by coarse cell."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    spark = corpus.sparkSession
    rows = corpus.where(F.col(vec_col).isNotNull()).select(c_key, F.col(vec_col).cast("array<double>").alias("v"))
    n = rows.count()
    if not n:
        raise ValueError("no vectors to index")
    cells = max(1, -(-n // per_cell))
    coarse = int(np.ceil(np.sqrt(cells)))
    share = min(1.0, SAMPLE_PER_CELL / per_cell)
    spot = F.pmod(F.xxhash64(c_key), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.where(spot < share) if n * share >= 4 * coarse else rows
    model = KMeans(k=coarse, seed=seed, maxIter=20, featuresCol="f").fit(sample.select(array_to_vector("v").alias("f")))
    cents = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "c int, centroid array<double>")
    cents.write.mode("overwrite").parquet(f"{path}/coarse")
    cents = spark.read.parquet(f"{path}/coarse")

    placed = sample.join(_nearest(sample, c_key, "v", cents, False).withColumnRenamed("c", "cell"), c_key)
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    kept = placed.join(F.broadcast(sizes), "cell").where(  # a row per coarse cell
        F.pmod(F.xxhash64(c_key, F.lit(seed)), F.lit(1 << 20)) / float(1 << 20) * F.col("size") < SAMPLE_PER_COARSE)
    want = max(1, round(per_cell * share))

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        k = max(1, -(-int(pdf["size"].iloc[0]) // want))
        c = _lloyd(np.stack([np.asarray(v) for v in pdf.sort_values(c_key)["v"]]), k, seed)
        cell = int(pdf["cell"].iloc[0])
        return pd.DataFrame({"nth": range(len(c)), "centroid": list(c), "cell": cell})

    fine = kept.groupBy("cell").applyInPandas(train, "nth long, centroid array<double>, cell int")
    fine = fine.select(((F.col("cell").cast("long") * (1 << 32)) + F.col("nth")).alias("c"), "centroid", "cell")
    fine.write.mode("overwrite").parquet(f"{path}/fine")
    _write(corpus, c_key, vec_col, path, "overwrite")


def _write(rows: DataFrame, c_key: str, vec_col: str, path: str, mode: str) -> None:
    spark = rows.sparkSession
    held = rows.where(F.col(vec_col).isNotNull())
    coarse = _nearest(held, c_key, vec_col, spark.read.parquet(f"{path}/coarse"), False).withColumnRenamed("c", "cell")
    fine = _nearest(held.join(coarse, c_key), c_key, vec_col, spark.read.parquet(f"{path}/fine"), True)
    out = held.join(coarse.withColumnRenamed("cell", "coarse"), c_key).join(fine.withColumnRenamed("c", "cell"), c_key)
    out.repartitionByRange("coarse", "cell", c_key).sortWithinPartitions("coarse", "cell").write.mode(mode).partitionBy("coarse").parquet(
        f"{path}/vectors")


def add(rows: DataFrame, c_key: str, vec_col: str, path: str) -> None:
    """Place new rows by the stored centroids and append them."""
    _write(rows, c_key, vec_col, path, "append")


def search(queries: DataFrame, path: str, q_key: str, c_key: str, vec_col: str = "embedding", k: int = 4, nprobe: int = 8,
           coarse_probe: int | None = None, metric: str = "dot") -> DataFrame:
    """`(q_key, c_key, score, rank)`: top-k among the vectors of the `nprobe` nearest
    cells, looked for in the `coarse_probe` nearest coarse cells (by default a
    quarter of `nprobe`, two at least); exact within them, and in all if both are
    as many as there are. Only folders of probed coarse cells are read."""
    spark = queries.sparkSession
    asked = queries.where(F.col(vec_col).isNotNull()).select(q_key, F.col(vec_col).cast("array<double>").alias("v"))
    near = _nearest(asked, q_key, "v", spark.read.parquet(f"{path}/coarse"), False, coarse_probe or max(2, nprobe // 4))
    near = near.withColumnRenamed("c", "cell")
    probes = _nearest(asked.join(near, q_key), q_key, "v", spark.read.parquet(f"{path}/fine"), True, nprobe)
    # a query goes to a coarse cell once, with the list of its cells there
    probes = probes.groupBy(q_key, F.shiftright("c", 32).cast("int").alias("cell")).agg(F.collect_set("c").alias("__cells"))
    folders = probes.select("cell").distinct()  # at most one row per coarse cell
    probes = asked.join(probes, q_key).select(q_key, F.col("v").alias("__qv"), "cell", "__cells")
    vectors = spark.read.parquet(f"{path}/vectors").join(F.broadcast(folders.withColumnRenamed("cell", "coarse")), "coarse", "left_semi")
    vectors = vectors.select(c_key, F.col("coarse").alias("cell"), F.col("cell").alias("__in"), vec_col)
    return R._block_products(probes, vectors, q_key, c_key, vec_col, k, metric, 1024)
