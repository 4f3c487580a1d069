"""Running sums and maxima over long ordered groups: within blocks of the order, plus what the blocks before hold.

A log or a session is cut at multiples of ``width`` of its order column, so one with a
third of all rows is spread over many tasks; only one row for each block is ordered by key.
Order values should not repeat within a key (rows that share one are in any order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 10_000


def running(df: DataFrame, key: str, order: str, width: int = WIDTH, **values: tuple[str, Column]) -> DataFrame:
    """``df`` with a column for each of ``values``, ("sum" or "max", expression): over the key's rows up to this one."""
    combine = {"sum": F.sum, "max": F.max}
    names = {c: f"_v_{c}" for c in values}
    rows = df.withColumns({"_block": F.floor(F.col(order) / width), **{names[c]: v for c, (_, v) in values.items()}})
    within = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(key, "_block").agg(*[combine[kind](names[c]).alias(c) for c, (kind, _) in values.items()])
    base = totals.select(F.col(key).alias("_key"), F.col("_block").alias("_b"), *[combine[kind](c).over(before).alias(f"_base_{c}") for c, (kind, _) in values.items()])
    inner = rows.withColumns({c: combine[kind](names[c]).over(within) for c, (kind, _) in values.items()})
    met = inner.join(base, F.col(key).eqNullSafe(F.col("_key")) & F.col("_block").eqNullSafe(F.col("_b")), "left")
    whole = {c: F.coalesce(F.col(c) + F.col(f"_base_{c}"), c, f"_base_{c}") if kind == "sum" else F.greatest(c, f"_base_{c}") for c, (kind, _) in values.items()}
    return met.withColumns(whole).select(*df.columns, *values)


def sliding(df: DataFrame, key: str, index: str, size: int, width: int = WIDTH, **values: Column) -> DataFrame:
    """``df`` with aggregates over a row and the ``size - 1`` before it; ``index`` numbers a key's rows from 1.

    The last rows of a block are also given to the next one.
    """
    block = F.floor((F.col(index) - 1) / width)
    last = (F.col(index) - 1) % width >= width - (size - 1)
    blocks = F.when(last, F.array(block, block + 1)).otherwise(F.array(block))
    rows = df.withColumn("_own", block).withColumn("_block", F.explode(blocks))
    w = Window.partitionBy(key, "_block").orderBy(index).rowsBetween(-(size - 1), 0)
    return rows.withColumns({c: v.over(w) for c, v in values.items()}).where("_own = _block").drop("_own", "_block")
