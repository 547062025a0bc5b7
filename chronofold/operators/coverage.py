"""What part of time, and which keys, a source history covers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofold.functions.columns import all_of
from chronofold.sources.history import SRC_END, SRC_START

def source_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return source.where(all_of(F.col(k).isNotNull() for k in keys)).select(*keys).distinct()


def covered_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key occurs in the source."""
    return target.join(source_keys(source, keys), list(keys), "left_semi")


def uncovered_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key does not occur in the source."""
    return target.join(source_keys(source, keys), list(keys), "left_anti")


def coverage_steps(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How far the source rows that start on or before a day reach, as a step function per key.

    One row per key and distinct start: ``_reach`` holds from ``_from`` to before ``_until``.
    Rows of one key and start are combined before the shuffle by key, so a window group is
    bounded by the number of calendar days, not by the number of source rows.
    """
    starts = (
        source
        .where(all_of(F.col(c).isNotNull() for c in (*keys, SRC_START, SRC_END)))
        .groupBy(*keys, SRC_START).agg(F.max(SRC_END).alias("_end"))
    )
    by_start = Window.partitionBy(*keys).orderBy(SRC_START)
    so_far = by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return starts.select(
        *keys,
        F.col(SRC_START).alias("_from"),
        F.lead(SRC_START).over(by_start).alias("_until"),
        F.lag(SRC_START).over(by_start).isNull().alias("_is_first"),
        F.max("_end").over(so_far).alias("_reach"),
        F.max(F.greatest("_end", SRC_START)).over(so_far).alias("_covered_to"),
    )


def source_gaps(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The windows no source row covers, for every key that has dated source rows.

    The one before the first source row has no start and the one after the last has no end: NULL
    stands for all time on that side.
    """
    no_day = F.lit(None).cast("date")
    before = F.when(
        F.col("_is_first"),
        F.struct(no_day.alias(SRC_START), F.col("_from").alias(SRC_END)))
    after = F.when(
        F.col("_until").isNull() | (F.col("_covered_to") < F.col("_until")),
        F.struct(F.col("_covered_to").alias(SRC_START), F.col("_until").alias(SRC_END)))
    return coverage_steps(source, keys).select(
        *keys, F.inline(F.filter(F.array(before, after), lambda gap: gap.isNotNull())))
