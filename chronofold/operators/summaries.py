"""Counts and listings that accompany a back-fill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.spec import HistorySpec


def preflight_counts(target: DataFrame, source: DataFrame, spec: HistorySpec) -> DataFrame:
    """One row: target rows, source rows, distinct source keys. Counted per source key first."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    complete = ~F.lit(False)
    for k in spec.keys:
        complete = complete & F.col(k).isNotNull()
    per_key = source.groupBy(*spec.keys).agg(F.count("*").alias("_rows"))
    return (
        target.select(one.alias("_t"), none.alias("_s"), none.alias("_k"))
        .unionAll(per_key.select(none, "_rows", complete.cast("long")))
        .agg(F.coalesce(F.sum("_t"), none).alias("target_rows_before"),
             F.coalesce(F.sum("_s"), none).alias("source_rows"),
             F.coalesce(F.sum("_k"), none).alias("source_distinct_ids"))
    )


def population_summary(table: DataFrame, spec: HistorySpec, column: str) -> DataFrame:
    """Rows in total, with and without a value (NULL if there are none), and distinct keys."""
    return table.agg(
        F.count("*").alias("total_rows_after"),
        F.sum(F.when(F.col(column).isNotNull(), 1)).alias(f"rows_with_{column}"),
        F.sum(F.when(F.col(column).isNull(), 1)).alias(f"rows_without_{column}"),
        F.count_distinct(*spec.keys).alias("distinct_ids"),
    )


def key_summary(table: DataFrame, spec: HistorySpec) -> DataFrame:
    """Per key: rows, active rows, first start, last end, distinct values of each new column."""
    return table.groupBy(*spec.keys).agg(
        F.count("*").alias("history_rows"),
        F.sum(spec.active).alias("active_rows"),
        F.min(spec.start).alias("earliest_start"),
        F.max(spec.end).alias("latest_end"),
        *[F.count_distinct(c).alias(f"distinct_{c}_values") for c in spec.new_cols],
    )


def expansion_ratio(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows after per row before; NULL for an empty table."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    rows = (before.select(one.alias("_before"), none.alias("_after"))
            .unionAll(after.select(none, one))
            .agg(F.sum("_before").alias("input_rows"), F.sum("_after").alias("output_rows")))
    return rows.withColumn(
        "expansion_ratio", F.try_divide(F.col("output_rows").cast("double"),
                                        F.col("input_rows").cast("double")))


def listing(table: DataFrame, spec: HistorySpec) -> DataFrame:
    """The table in key and start order."""
    return table.select(*spec.target_cols).orderBy(*spec.keys, spec.start, spec.end)
