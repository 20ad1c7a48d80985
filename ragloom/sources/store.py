"""The vector collection as a Parquet table: S11 open, S12 append, S13 insert
absent ids, S14 overwrite, S15 bounded batches.

One row per id `(id, document, embedding | sparse rows, metadata, ...)`, so
the reference's "parallel arrays of equal length" rule is structural. All
writes are Spark writes (tasks write their own files; no data through the
driver). Paths should be shared storage on a cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ragloom.plans.sizing import MAX_BROADCAST_ROWS

# Fixed value: insert batch size of the reference's loading script.
DEFAULT_BATCH = 1000


def exists(spark: SparkSession, path: str) -> bool:
    """True when `path` holds a readable Parquet table."""
    try:
        spark.read.parquet(path).schema  # noqa: B018 — listing only, no data read
        return True
    except AnalysisException:
        return False


def open_store(spark: SparkSession, path: str, schema: str | None = None, create: bool = False) -> DataFrame | None:
    """Open the collection. Missing and `create=False` → None (the caller
    reports it, as the chat command does); missing and `create=True` → an
    empty collection with `schema` is written first (get-or-create)."""
    if exists(spark, path):
        return spark.read.parquet(path)
    if not create:
        return None
    if schema is None:
        raise ValueError("schema is required to create a store")
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def append(df: DataFrame, path: str, id_col: str = "id", generate_ids: bool = True) -> None:
    """Add rows; with `generate_ids` each row gets a fresh random id, so
    re-running the same input adds duplicates (the reference's behaviour
    without `--clear`)."""
    out = df.withColumn(id_col, F.expr("uuid()")) if generate_ids else df
    out.write.mode("append").parquet(path)


def bucketed(spark: SparkSession, path: str, schema: T.StructType, id_col: str, buckets: int) -> str:
    """Name of the table whose files under `path` are bucketed by `id_col`; a session that
    does not know it yet registers it (the same buckets in every session). Joins on
    the id then read the stored side where it lies."""
    name = f"store_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet CLUSTERED BY ({id_col}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def insert_absent(spark: SparkSession, df: DataFrame, path: str, id_col: str = "id", buckets: int | None = None) -> DataFrame:
    """S13 + J6: add only rows whose id is not stored yet; existing ids are left
    untouched. Duplicate ids inside one batch fail the write (the store rejects
    them too) and leave the store as it was. Returns the rows that were added.
    Rows without an id are always new.

    A first pass counts ids alone, so rows stay where they are: see `absent_rows`.
    With `buckets` the store is bucketed by id (see `bucketed`) and written in one
    plan: the stored side is not shuffled, and the rows are dealt once, the way
    they are stored."""
    twice = F.raise_error(F.concat(F.lit("duplicate id in batch: "), F.col(id_col).cast("string")))
    once = F.when((F.col("__n") > 1) & F.col(id_col).isNotNull(), twice).otherwise(F.lit(True))
    before: set[str] = set()
    if buckets:
        df = df.repartition(buckets, id_col)
        stored = spark.table(bucketed(spark, path, df.schema, id_col, buckets))
        before = set(stored.inputFiles())
        checked = df.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(id_col))).where(once).drop("__n")
        name = bucketed(spark, path, df.schema, id_col, buckets)
        checked.join(stored.select(id_col), id_col, "left_anti").select(*df.columns).write.insertInto(name)
        spark.catalog.refreshTable(name)
    else:
        stored = spark.read.parquet(path) if exists(spark, path) else None
        before = set(stored.inputFiles()) if stored is not None else before
        ids = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("__n")).where(once).select(id_col)
        new = absent_rows(df, ids, stored, id_col)
        if new is None:
            return spark.createDataFrame([], df.schema)
        new.write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    added = sorted(set(spark.read.schema(df.schema).parquet(path).inputFiles()) - before)
    return spark.read.schema(df.schema).parquet(*added) if added else spark.createDataFrame([], df.schema)


def absent_rows(df: DataFrame, ids: DataFrame, stored: DataFrame | None, id_col: str) -> DataFrame | None:
    """Rows of `df` whose id is not among the `stored` ones; None if the store has them all.

    `ids` holds the ids of `df`, each once. Only they cross the network: if all are new,
    the rows are taken whole; if up to MAX_BROADCAST_ROWS are, the new ids go to the
    rows. Beyond that the rows meet the stored ids by a shuffle. Runs one job, over ids."""
    if stored is None:
        ids.count()  # whatever `ids` checks
        return df
    held = stored.select(id_col).distinct().withColumn("__held", F.lit(True))
    met = ids.join(held, id_col, "left")
    n, new = met.agg(F.count(F.lit(1)), F.count_if(F.col("__held").isNull())).first()
    if not new and stored.inputFiles():
        return None
    if new == n:
        return df
    if new > MAX_BROADCAST_ROWS:
        return df.join(stored.select(id_col), id_col, "left_anti").select(*df.columns)
    absent = F.broadcast(met.where("__held IS NULL").select(F.col(id_col).alias("__absent")))
    return df.join(absent, F.col(id_col).eqNullSafe(F.col("__absent")), "left_semi")


def overwrite(spark: SparkSession, df: DataFrame, path: str, swap: bool = True) -> str:
    """Replace the collection (`--clear`). The new version is written
    completely next to the old one first; with `swap` the live path is then
    renamed aside (kept as `<path>_old_<id>` for the caller to expire) and the
    new version renamed into place, so readers keep using `path`. Returns the
    path holding the new version."""
    tag = uuid.uuid4().hex[:12]
    new_path = f"{path.rstrip('/')}_v{tag}"
    df.write.mode("overwrite").parquet(new_path)
    if not swap:
        return new_path
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    live = jvm.org.apache.hadoop.fs.Path(path)
    fs = live.getFileSystem(conf)
    if fs.exists(live):
        fs.rename(live, jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}_old_{tag}"))
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(new_path), live):
        raise OSError(f"could not move {new_path} to {path}")
    return path


def batched_write(df: DataFrame, path: str, order_col: str, batch: int = DEFAULT_BATCH,
                  mode: str = "append") -> None:
    """Write in bounded batches: at most `batch` rows per file, and a
    `batch_id = floor(ordinal / batch)` column (ordinal from `with_ordinal`)."""
    from ragloom.operators.rows import with_ordinal
    out = with_ordinal(df, [order_col], "ordinal")
    out = out.withColumn("batch_id", F.floor(F.col("ordinal") / batch).cast("long"))
    out.write.mode(mode).option("maxRecordsPerFile", batch).parquet(path)
