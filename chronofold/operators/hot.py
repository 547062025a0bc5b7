"""Overlap join for keys too large for one task: time segments x salts.

A hot key is cut into time segments (so a row meets only rows of its own period) and each segment
into target salts x source salts (so no task holds all rows of a segment). A pair may share several
segments; it is emitted in the one where its intersection begins, hence exactly once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions.columns import all_of, content_hash
from chronofold.operators.coverage import coverage_steps
from chronofold.sources.history import SRC_END, SRC_START
from chronofold.spec import HistorySpec, JoinTuning

_FEW_KEYS = 100
_PLAN_COLS = ("_lo", "_width", "_segments", "_t_salts", "_s_salts")


@dataclass(frozen=True)
class HotKeys:
    """``plan`` has one row per hot key, and is marked for broadcast if it is bounded; ``scan_filter``
    is a filter on the key columns that keeps all hot keys and that a scan can use to skip row
    groups, if the keys are few."""

    plan: DataFrame
    scan_filter: Column | None


def may_have_hot_keys(target: DataFrame, source: DataFrame, spec: HistorySpec,
                       tuning: JoinTuning, rows: int | None = None) -> bool:
    """Whether the largest source key could be hot if all target rows were its own.

    Reads the source's keys and counts the target's ``rows``, if not given; tables answer that from their footers.
    """
    most = source.groupBy(*spec.keys).agg(F.count("*").alias("_s")).agg(F.max("_s")).first()[0]
    if not most:
        return False
    rows = target.count() if rows is None else rows
    return rows * most > tuning.hot_pairs or max(rows, most) > tuning.hot_rows


def counted_keys(target: DataFrame, source: DataFrame, spec: HistorySpec,
                 tuning: JoinTuning) -> DataFrame:
    """Keys that are hot: rows of both sides (``_t``, ``_s``), first day and number of days.

    Reads key and start columns only and combines them map-side.
    """
    keys = [f"`{k}`" for k in spec.keys]
    return (
        target.selectExpr(*keys, f"`{spec.start}` AS _day", "1L AS _t", "0L AS _s")
        .unionAll(source.selectExpr(*keys, SRC_START, "0L", "1L"))
        .where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
        .groupBy(*spec.keys)
        .agg(F.expr("sum(_t) AS _t"), F.expr("sum(_s) AS _s"),
             F.expr("coalesce(unix_date(min(_day)), 0) AS _lo"),
             F.expr("coalesce(datediff(max(_day), min(_day)) + 1, 1) AS _days"))
        .where("_s > 0")
        .where(f"double(_t) * _s > {tuning.hot_pairs} OR greatest(_t, _s) > {tuning.hot_rows}")
    )


def hot_keys(target: DataFrame, source: DataFrame, spec: HistorySpec,
             tuning: JoinTuning, rows: int | None = None) -> HotKeys | None:
    """The largest source keys with their segments and salts; None if no key is large.

    The result has at most ``max_hot_keys`` rows, so it may pass the driver and be broadcast; keys
    beyond it stay in the ordinary join, which is exact too.
    """
    if not may_have_hot_keys(target, source, spec, tuning, rows):
        return None
    found = (
        counted_keys(target, source, spec, tuning)
        .orderBy(F.expr("double(_t) * _s").desc(), *spec.keys)
        .limit(tuning.max_hot_keys)
    )
    rows = found.collect()
    if not rows:
        return None
    schema = T.StructType(
        [T.StructField(f"_hot_{k}", found.schema[k].dataType) for k in spec.keys]
        + [T.StructField(c, T.IntegerType()) for c in _PLAN_COLS])
    plan = target.sparkSession.createDataFrame(
        [tuple(row[k] for k in spec.keys) + _layout(row, tuning) for row in rows], schema)
    few = len(rows) <= _FEW_KEYS
    return HotKeys(F.broadcast(plan), all_of(
        F.col(k).isin(list({row[k] for row in rows})) for k in spec.keys) if few else None)


def _layout(row, tuning: JoinTuning) -> tuple[int, ...]:
    """First day, days per segment, segments, and salts of each side of one hot key."""
    smaller = min(row._t, row._s)
    segments = max(1, min(-(-smaller // tuning.segment_rows), row._days, tuning.max_segments))
    cell = segments * tuning.cell_rows
    salts = (max(1, -(-rows // cell)) for rows in (row._t, row._s))
    return (row._lo, -(-row._days // segments), segments, *salts)


def _match(spec: HistorySpec) -> Column:
    return all_of(F.col(k) == F.col(f"_hot_{k}") for k in spec.keys)


def without_hot(rows: DataFrame, hot: HotKeys, spec: HistorySpec) -> DataFrame:
    return rows.join(hot.plan, _match(spec), "left_anti")


def only_hot(rows: DataFrame, hot: HotKeys, spec: HistorySpec) -> DataFrame:
    """Rows of hot keys, with the plan of their key."""
    near = rows if hot.scan_filter is None else rows.where(hot.scan_filter)
    return near.join(hot.plan, _match(spec)).drop(*[f"_hot_{k}" for k in spec.keys])


def first_segment(day: Column) -> Column:
    """Days before the first segment, and no day at all, count to the first."""
    raw = F.floor((F.unix_date(day) - F.col("_lo")) / F.col("_width"))
    return F.greatest(F.lit(0), F.least(F.col("_segments") - 1, F.coalesce(raw, F.lit(0)))).cast("int")


def last_segment(day: Column) -> Column:
    """As ``first_segment``, but no day at all counts to the last."""
    return F.when(day.isNull(), F.col("_segments") - 1).otherwise(first_segment(day)).cast("int")


def _touched(first: Column, last: Column) -> Column:
    begin = first_segment(first)
    return F.explode(F.sequence(begin, F.greatest(begin, last_segment(last))))


def _own_salt(rows: DataFrame, salts: str) -> Column:
    """A salt from the row's content, so a task that is run again places the row alike."""
    return F.pmod(content_hash(rows, _PLAN_COLS), F.col(salts)).cast("int")


def _all_salts(salts: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(salts) - 1))


def hot_pairs(target: DataFrame, timeline: DataFrame, spec: HistorySpec,
              meets: Column) -> DataFrame:
    """Every (target, timeline) pair of the hot keys that ``meets``; both sides carry the key plan."""
    left = (
        target
        .withColumn("_t_salt", _own_salt(target, "_t_salts"))
        .withColumn("_s_salt", _all_salts("_s_salts"))
        .withColumn("_first", first_segment(F.col(spec.start)))
        .withColumn("_cell", _touched(F.col(spec.start), F.col(spec.end)))
        .drop(*_PLAN_COLS)
    )
    right = (
        timeline
        .withColumn("_src_s_salt", _own_salt(timeline, "_s_salts"))
        .withColumn("_src_t_salt", _all_salts("_t_salts"))
        .withColumn("_src_first", first_segment(F.col(SRC_START)))
        .withColumn("_src_cell", _touched(F.col(SRC_START), F.col(SRC_END)))
        .drop(*_PLAN_COLS)
        .withColumnsRenamed({k: f"_src_key_{k}" for k in spec.keys})
    )
    same_cell = all_of(
        [F.col(k) == F.col(f"_src_key_{k}") for k in spec.keys]
        + [F.col(c) == F.col(f"_src{c}") for c in ("_cell", "_t_salt", "_s_salt")])
    begins_here = F.greatest("_first", "_src_first") == F.col("_cell")
    on = same_cell & begins_here & meets
    helpers = ("_cell", "_t_salt", "_s_salt", "_first")
    return left.join(right, on).drop(
        *helpers, *[f"_src{c}" for c in helpers], *[f"_src_key_{k}" for k in spec.keys])


def hot_unmatched(target: DataFrame, source: DataFrame, hot: HotKeys,
                  spec: HistorySpec) -> DataFrame:
    """Target rows of hot keys that overlap no source row.

    A row has a match exactly if the source rows that start before its end reach past its start,
    so one look-up of its last day in the step function decides; no pair is built.
    """
    steps = (
        only_hot(coverage_steps(source, spec.keys), hot, spec)
        .withColumn("_src_t_salt", _all_salts("_t_salts"))
        .withColumn("_src_cell", _touched(F.col("_from"), F.date_sub("_until", 1)))
        .select(*[F.col(k).alias(f"_src_key_{k}") for k in spec.keys],
                "_src_t_salt", "_src_cell", "_from", "_until", "_reach")
    )
    last_day = F.date_sub(F.col(spec.end), 1)
    looked_up = target.select(
        *spec.target_cols,
        _own_salt(target, "_t_salts").alias("_t_salt"),
        last_day.alias("_last_day"),
        first_segment(last_day).alias("_cell"),
    ).join(
        steps,
        all_of([F.col(k) == F.col(f"_src_key_{k}") for k in spec.keys]
               + [F.col(c) == F.col(f"_src{c}") for c in ("_cell", "_t_salt")])
        & (F.col("_from") <= F.col("_last_day"))
        & (F.col("_until").isNull() | (F.col("_last_day") < F.col("_until"))),
        "left")
    reached = F.coalesce(F.col("_reach") > F.col(spec.start), F.lit(False))
    return looked_up.where(~reached).select(*spec.target_cols)
