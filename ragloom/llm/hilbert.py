"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised (equal-frequency cuts from one
mergeable quantile pass), the cells are numbered along a Hilbert curve, rows
are ordered by cell and cut into shards of equal row counts. Neighbouring
cells are alike in every dimension, so files of a shard have narrow ranges in
all of them and readers can skip files by any one.

Global positions come from counts of bounded groups: a cell is split by the
hash of its key into groups of about GROUP_ROWS rows, so a cell with a third of
all rows is many groups; positions inside a group are one small window, and the
groups' offsets are a running sum over group counts.

Only DataFrame functions run. Defined cases: nulls sort before every value in
their dimension; ties and repeated rows have adjacent positions (equal rows
are interchangeable); fewer rows than shards leave shards empty; an empty table
gives no rows; extra columns pass through under any names (`h`, `shard` and
`slot` are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragloom.llm.common import keep

BITS = 4
GROUP_ROWS = 20_000


def _number(column: Column, kind: str) -> Column:
    """An order-preserving number: strings by their first six bytes."""
    if kind == "string":
        return F.conv(F.rpad(F.hex(F.substring(F.encode(column, "utf-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return column.cast("double")


def cuts(df: DataFrame, dims: list[str], bits: int = BITS) -> dict[str, list[float]]:
    """Quantile boundaries of each dimension: 2^bits - 1 numbers each."""
    n = 1 << bits
    kinds = dict(df.dtypes)
    row = df.agg(*[F.percentile_approx(_number(F.col(d), kinds[d]), [i / n for i in range(1, n)], 10_000).alias(d)
                   for d in dims]).first()
    return {d: sorted(set(row[d] or [])) for d in dims}


def _cell(df: DataFrame, bounds: dict[str, list[float]], bits: int) -> Column:
    """Grid coordinates of a row packed into one integer."""
    kinds, cell = dict(df.dtypes), F.lit(0)
    for d, edges in bounds.items():
        number = _number(F.col(d), kinds[d])
        x = F.lit(0)
        for e in edges:
            x = x + F.when(number >= e, 1).otherwise(0)
        cell = F.shiftleft(cell, bits) + x
    return cell.cast("int")


def curve(n_dims: int, spark, bits: int = BITS) -> DataFrame:
    """(cell, h): the place of every packed grid cell along the Hilbert curve.
    Skilling's transform as folds over small arrays: undo the rotations from
    the highest bit down, Gray-code the coordinates, interleave their bits."""
    steps = ", ".join(f"named_struct('q', {1 << b}, 'i', {i})" for b in range(bits - 1, 0, -1) for i in range(n_dims))
    highs = ", ".join(str(1 << b) for b in range(bits - 1, 0, -1))
    axes = ", ".join(f"cast(shiftright(id, {bits * (n_dims - 1 - i)}) & {(1 << bits) - 1} as int)" for i in range(n_dims))
    turn = """transform(a, (v, k) -> case
        when (a[s.i] & s.q) <> 0 then (case when k = 0 then v ^ (s.q - 1) else v end)
        when k = 0 or k = s.i then v ^ ((a[0] ^ a[s.i]) & (s.q - 1))
        else v end)"""
    return (spark.range(1 << (bits * n_dims)).selectExpr("cast(id as int) cell", f"array({axes}) x")
            .selectExpr("cell", f"aggregate(array({steps}), x, (a, s) -> {turn}) x")
            .selectExpr("cell", "transform(x, (v, k) -> aggregate(slice(x, 1, k + 1), 0, (g, y) -> g ^ y)) g")
            .selectExpr("cell", "g", f"aggregate(array({highs}), 0, (t, q) -> t ^ "
                        f"(case when (g[{n_dims - 1}] & q) <> 0 then q - 1 else 0 end)) t")
            .selectExpr("cell", f"aggregate(sequence({bits - 1}, 0, -1), 0, (h, b) -> aggregate(g, h, "
                        "(o, v) -> o * 2 + (shiftright(v ^ t, b) & 1))) h"))


def assign(df: DataFrame, shards: int, dims: list[str], key: str, bits: int = BITS) -> DataFrame:
    """`df` with `h` (curve index), `shard` (0 to shards - 1, row counts at most
    one apart) and `slot` (gapless from 0 within the shard)."""
    bounds = cuts(df, dims, bits)
    grid = keep(curve(len(dims), df.sparkSession, bits), "grid")
    row, place = F.col("row"), ["h", "group"]
    # the grid has 2^(bits * dims) rows, a parameter: broadcast
    coded = df.select(_cell(df, bounds, bits).alias("cell"), F.xxhash64(key).alias("hash"), F.struct("*").alias("row"))
    coded = coded.join(F.broadcast(grid), "cell").drop("cell")
    size = keep(coded.groupBy("h").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int").alias("groups")), "cells")
    # at most one row per grid cell: broadcast
    coded = coded.join(F.broadcast(size), "h").withColumn(
        "group", F.floor(F.shiftrightunsigned(F.col("hash"), 33) * F.col("groups") / F.lit(float(1 << 31))).cast("int"))
    counts = keep(coded.groupBy(*place).agg(F.count(F.lit(1)).alias("n")), "groups")
    total = counts.agg(F.sum("n")).first()[0] or 0
    order = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*place, F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy(*place).orderBy("hash", row[key], *[row[c] for c in df.columns if c in dims]))
    placed = coded.withColumn("rank", rank).join(offsets, place).withColumn("pos", F.col("before") + F.col("rank") - 1)
    # shard s starts at ceil(s * total / shards)
    placed = placed.withColumn("shard", F.expr(f"cast((pos * {shards}L) div {max(total, 1)}L as int)"))
    slot = F.expr(f"pos - ((cast(shard as bigint) * {total}L) + {shards - 1}L) div {shards}L").cast("long")
    return placed.select(*(row[c].alias(c) for c in df.columns if c not in ("h", "shard", "slot")), "h", "shard", slot.alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int, dims: list[str], key: str) -> None:
    """Write `df` as one folder per shard, rows in curve order; a shard is cut
    over as many tasks as it needs."""
    out = assign(df, shards, dims, key)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
