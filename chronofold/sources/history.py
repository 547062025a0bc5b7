"""Scans that bring target and source histories to the shape the operators expect."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronofold.spec import HistorySpec

SRC_START, SRC_END = "_src_start", "_src_end"


def src_value(name: str) -> str:
    return f"_src_{name}"


def read_parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def target_history(table: DataFrame, spec: HistorySpec,
                   source: DataFrame | None = None) -> DataFrame:
    """Configured target columns only, in output order, with both bounds as dates.

    New columns that the table does not have yet are added as NULL, in the type that the raw
    ``source`` table has them in.
    """
    there = {c.lower() for c in table.columns}
    types = {f.name.lower(): f.dataType for f in source.schema} if source is not None else {}

    def column(c: str) -> Column:
        if c in spec.new_cols and c.lower() not in there:
            if c.lower() not in types:
                raise ValueError(f"the target has no column {c}; pass the source to add it")
            return F.lit(None).cast(types[c.lower()]).alias(c)
        return F.col(c).cast("date").alias(c) if c in (spec.start, spec.end) else F.col(c)

    return table.select(*[column(c) for c in spec.target_cols])


def lower_names(table: DataFrame) -> DataFrame:
    """Lower-case every column name; names that would collide are refused."""
    lowered = [c.lower() for c in table.columns]
    clashes = [c for c, n in Counter(lowered).items() if n > 1]
    if clashes:
        raise ValueError(f"columns differ only in case: {clashes}")
    return table.toDF(*lowered)


def source_history(table: DataFrame, spec: HistorySpec) -> DataFrame:
    """Keys, new columns and dates of the source under names that cannot collide with the target."""
    return lower_names(table).select(
        *[F.col(k.lower()).alias(k) for k in spec.keys],
        *[F.col(c.lower()).alias(src_value(c)) for c in spec.new_cols],
        F.col(spec.src_start.lower()).cast("date").alias(SRC_START),
        F.col(spec.src_end.lower()).cast("date").alias(SRC_END),
    )


def windows_from_events(
    events: DataFrame,
    keys: Sequence[str],
    day: Column,
    values: dict[str, Column],
    start: str,
    end: str,
    last_end: str,
    max_days: int | None = None,
) -> DataFrame:
    """Turn dated events into a history: one row per key and day, valid until the next one.

    With ``max_days`` a row is valid for at most that long, which leaves gaps.

    Of the events of one key and day the smallest (compared value by value, in the given order)
    stands for the day, as a whole. They are combined before the shuffle by key, so a window group
    holds at most one row per calendar day however many events its key has.
    """
    whole = F.struct(*[value.alias(name) for name, value in values.items()])
    daily = events.groupBy(*keys, day.cast("date").alias(start)).agg(F.min(whole).alias("_event"))
    daily = daily.select(*keys, start, *[F.col(f"_event.{name}").alias(name) for name in values])
    following = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    until = F.coalesce(following, F.lit(last_end).cast("date"))
    if max_days is not None:
        until = F.least(until, F.date_add(start, max_days))
    return daily.withColumn(end, until)
