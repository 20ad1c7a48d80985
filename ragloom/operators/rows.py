"""Row identity helpers: P5 ids, P6 constant metadata, global ordinals.

A global 0-based ordinal in a given order is computed without moving all
rows into one task: a range-partitioned sort, then per-partition counts (one
row per partition, broadcast) turned into offsets, then the partition offset
plus the row's position inside its partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def make_id(*parts: Column | str, sep: str = "_") -> Column:
    """P5: `{path}_{i}`-style ids from the given columns."""
    cols = [F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]
    return F.concat_ws(sep, *cols)


def constant_metadata(**kv: str) -> Column:
    """The same literal metadata map on every row."""
    args = []
    for k, v in kv.items():
        args += [F.lit(k), F.lit(v)]
    return F.create_map(*args)


def _pin(tagged: DataFrame) -> DataFrame:
    """Materialise the range-sorted, position-tagged rows once, reliably.

    The range partitioner samples its boundaries when its shuffle is built;
    two separate jobs over the same plan may cut partitions differently, so
    positions and per-partition offsets must come from one computation. A
    reliable checkpoint (the shared `spark.checkpoint.dir`) fixes that
    computation on storage: lost executors cannot change it.
    """
    from ragloom.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(tagged.sparkSession)
    return tagged.checkpoint(eager=True)


def with_ordinal(df: DataFrame, order_cols: Sequence[str], out_col: str = "ordinal") -> DataFrame:
    """0-based position of each row in `order_cols` order (ties broken by the
    remaining columns' order being undefined — pass a unique key).

    Plan: `orderBy` (range exchange, sorted partitions) → `spark_partition_id`
    + `monotonically_increasing_id` (consecutive within a partition) →
    per-partition row counts → running offsets (one row per partition,
    broadcast) → ordinal = offset + position. The sorted rows are kept and
    computed once (see `_pin`); no single-task window.
    """
    sorted_df = df.orderBy(*order_cols)
    tagged = sorted_df.withColumn("__pid", F.spark_partition_id()).withColumn(
        "__mid", F.monotonically_increasing_id())
    # within a partition, mid = (pid << 33) + position
    tagged = tagged.withColumn("__pos", F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33))
    tagged = _pin(tagged)
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(
        "__off", F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = offsets.select("__pid", F.coalesce(F.col("__off"), F.lit(0)).alias("__off"))
    out = tagged.join(F.broadcast(offsets), "__pid")
    return out.withColumn(out_col, (F.col("__off") + F.col("__pos")).cast("long")).drop(
        "__pid", "__mid", "__pos", "__off")


def with_group_ordinal(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                       out_col: str = "ordinal") -> DataFrame:
    """0-based position of each row inside its group, in `order_cols` order
    (pass a unique tie-breaker), without gathering a group into one task.

    Plan: a range sort on (group, order) — a group that holds a third of all
    rows is cut across many range partitions — then, per (partition, group),
    the row count and first position (one row per piece of a group), running
    offsets over a group's pieces in partition order, and
    ordinal = offset + (position − first position of the piece). The offset
    table has one row per group piece; it is broadcast when small (checked),
    joined by a shuffle otherwise.
    """
    from ragloom.plans.sizing import broadcast_if_small
    group_cols, order_cols = list(group_cols), list(order_cols)
    tagged = (df.orderBy(*group_cols, *order_cols)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__mid", F.monotonically_increasing_id()))
    tagged = tagged.withColumn("__pos", F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33))
    tagged = _pin(tagged)
    pieces = tagged.groupBy("__pid", *group_cols).agg(F.count(F.lit(1)).alias("__n"),
                                                      F.min("__pos").alias("__first"))
    before = Window.partitionBy(*group_cols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("__pid", *group_cols, "__first",
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    offsets, _ = broadcast_if_small(offsets, keep_first=False)     # cheap to recompute, may be large
    out = tagged.join(offsets, ["__pid", *group_cols])
    return out.withColumn(out_col, (F.col("__off") + F.col("__pos") - F.col("__first")).cast("long")).drop(
        "__pid", "__mid", "__pos", "__off", "__first")
