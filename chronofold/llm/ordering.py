"""Positions along an id order without ever sorting a table in one task.

Ids are cut into blocks of equal width, about ``ROWS`` rows each, and the blocks into about as many groups as each
group has blocks. Sums run inside a block, over the blocks of a group, and over the groups, so the largest single
window holds the square root of the number of blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS = 1024
BLOCK, GROUP = "__block", "__group"


def in_blocks(df: DataFrame, key: str, rows: int = ROWS) -> DataFrame:
    """Add the block and the group of each row. Rows whose id is null form the first block."""
    low, high, n = df.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    low, high = (low or 0), (high or 0)
    blocks = max(1, math.ceil(n / rows))
    width = (high - low) // blocks + 1
    per_group = max(1, math.isqrt(blocks))
    block = F.coalesce(F.expr(f"(`{key}` - {low}L) div {width}L"), F.lit(-1))
    return df.withColumn(BLOCK, block.cast("long")).withColumn(GROUP, F.expr(f"{BLOCK} div {per_group}L"))


def _before(value: Column, window: Window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def running_total(df: DataFrame, value: str, key: str, out: str, by: list[str] | None = None, ties: list[str] | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows that come before, in the order of ``key`` and then ``ties``.

    With ``by`` (columns without nulls) each group has its own order; a group may hold any share of the rows.
    """
    by = by or []
    blocked = in_blocks(df, key)
    sums = blocked.groupBy(*by, GROUP, BLOCK).agg(F.sum(value).alias("__sum"))
    groups = sums.groupBy(*by, GROUP).agg(F.sum("__sum").alias("__group_sum"))
    groups = groups.withColumn("__base", _before(F.col("__group_sum"), Window.partitionBy(*by).orderBy(GROUP))).drop("__group_sum")
    bases = sums.withColumn("__in_group", _before(F.col("__sum"), Window.partitionBy(*by, GROUP).orderBy(BLOCK))).drop("__sum")
    bases = bases.join(groups, [*by, GROUP]).select(*by, BLOCK, (F.col("__base") + F.col("__in_group")).alias("__base"))
    inside = _before(F.col(value), Window.partitionBy(*by, BLOCK).orderBy(key, *(ties or [])))
    rows = blocked.withColumn("__inside", inside).join(bases, [*by, BLOCK])
    return rows.withColumn(out, (F.col("__base") + F.col("__inside")).cast("long")).drop("__base", "__inside", BLOCK, GROUP)


def next_blocks(blocked: DataFrame) -> DataFrame:
    """For each block that has rows, the next one that has (``following``); the first one after the last."""
    blocks = blocked.select(GROUP, BLOCK).distinct()
    groups = blocks.groupBy(GROUP).agg(F.min(BLOCK).alias("__first"))
    order = Window.orderBy(GROUP)
    first = F.first("__first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    groups = groups.select(GROUP, F.coalesce(F.lead("__first").over(order), first).alias("__next_first"))
    inside = F.lead(BLOCK).over(Window.partitionBy(GROUP).orderBy(BLOCK))
    return blocks.withColumn("__next", inside).join(groups, GROUP).select(BLOCK, F.coalesce("__next", "__next_first").alias("following"))
