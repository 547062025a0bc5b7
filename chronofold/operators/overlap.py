"""Expansion of a target history along the changes of a source history."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions.columns import all_of, content_hash, is_open, overlaps
from chronofold.operators.coverage import source_gaps, source_keys
from chronofold.operators.dyadic import dyadic_keys, dyadic_pairs
from chronofold.operators.hot import (
    HotKeys, hot_keys, hot_pairs, hot_unmatched, only_hot, without_hot)
from chronofold.session import dealt, written
from chronofold.sources.history import SRC_END, SRC_START, src_value
from chronofold.spec import COVERAGE_MODES, HistorySpec, JoinTuning

# What a target row was matched with: a source row, an uncovered stretch of time, or (only to tell
# that its key occurs in the source at all) the key.
KIND, ROW, GAP, KEY = "_kind", "row", "gap", "key"


def measured_bytes(df: DataFrame) -> int:
    """Uncompressed size of the rows, measured: fixed widths plus the actual lengths of text and
    binary values, and of nested values as text."""
    sized = {f.name: F.col(f.name) for f in df.schema
             if isinstance(f.dataType, (T.StringType, T.BinaryType))}
    sized |= {f.name: F.col(f.name).cast("string") for f in df.schema
              if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
    fixed = 16 + 8 * len(df.columns)
    lengths = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in sized.values()), F.lit(0))
    return df.agg(F.coalesce(F.sum(lengths + fixed), F.lit(0))).first()[0]


def _timeline(source: DataFrame, spec: HistorySpec, coverage: str) -> DataFrame:
    """Source rows plus what the coverage mode needs to know about unmatched target rows."""
    rows = source.withColumn(KIND, F.lit(ROW))
    if coverage == "inner":
        extra = source_keys(source, spec.keys).withColumn(KIND, F.lit(KEY))
    elif coverage == "preserve":
        extra = source_gaps(source, spec.keys).withColumn(KIND, F.lit(GAP))
    else:
        return rows
    return rows.unionByName(extra, allowMissingColumns=True)


def _meets(spec: HistorySpec, coverage: str) -> Column:
    """When a target row and a row of the timeline belong together, in every way to join them.

    A gap (whose NULL bounds are open) meets only target rows that hold time; a source row follows
    the plain overlap rule; a key meets every target row of it.
    """
    start, end = F.col(spec.start), F.col(spec.end)
    row = overlaps(start, end, F.col(SRC_START), F.col(SRC_END))
    if coverage == "inner":
        return F.when(F.col(KIND) == KEY, F.lit(True)).otherwise(row)
    if coverage == "preserve":
        gap = ((start < end) & F.coalesce(F.col(SRC_START) < end, F.lit(True))
               & F.coalesce(F.col(SRC_END) > start, F.lit(True)))
        return F.when(F.col(KIND) == GAP, gap).otherwise(row)
    return row


def _join(target: DataFrame, timeline: DataFrame, spec: HistorySpec, how: str, coverage: str,
          extra: Column | None = None) -> DataFrame:
    """Equality on the keys with the overlap as residual; the target is shuffled at most once."""
    renamed = timeline.withColumnsRenamed({k: f"_src_key_{k}" for k in spec.keys})
    on = all_of(F.col(k) == F.col(f"_src_key_{k}") for k in spec.keys) & _meets(spec, coverage)
    if extra is not None:
        on = on & extra
    return target.join(renamed, on, how).drop(*[f"_src_key_{k}" for k in spec.keys])


def _join_salted(target: DataFrame, timeline: DataFrame, spec: HistorySpec, how: str,
                 coverage: str, buckets: int) -> DataFrame:
    """Target rows spread over buckets, the timeline repeated in those that its key has rows in; the bucket is joined on."""
    keys = list(spec.keys)
    spread = target.withColumn("_salt", F.pmod(content_hash(target), F.lit(buckets)).cast("int"))
    used = written(spread.groupBy(*keys).agg(F.collect_set("_salt").alias("_salts"), F.count("*").alias("_rows")))
    repeated = timeline.join(used.drop("_rows"), keys).withColumn("_src_salt", F.explode("_salts")).drop("_salts")
    rows = used.agg(F.sum("_rows")).first()[0] or 0
    return _join(dealt(spread, rows, *keys, "_salt"), repeated, spec, how, coverage,
                 F.col("_salt") == F.col("_src_salt")).drop("_salt", "_src_salt")


def _attach_hot(target: DataFrame, source: DataFrame, hot: HotKeys, spec: HistorySpec,
                coverage: str, hot_pairs: Callable[..., DataFrame]) -> DataFrame:
    """Hot keys occur in the source, so no row of theirs is passed through by key."""
    big_target, big_source = only_hot(target, hot, spec), only_hot(source, hot, spec)
    rows = big_source.withColumn(KIND, F.lit(ROW))
    if coverage in ("pairs", "inner"):
        return hot_pairs(big_target, rows, spec, _meets(spec, "pairs"))
    if coverage == "left":
        pairs, rest = hot_pairs(big_target, rows, spec, _meets(spec, "left")), big_target
    else:
        dated = F.col(spec.start) < F.col(spec.end)
        gaps = only_hot(source_gaps(big_source, spec.keys), hot, spec).withColumn(KIND, F.lit(GAP))
        pairs = hot_pairs(big_target, rows.unionByName(gaps, allowMissingColumns=True), spec,
                          _meets(spec, coverage))
        rest = big_target.where(~F.coalesce(dated, F.lit(False)))
    unmatched = hot_unmatched(rest, big_source, hot, spec)
    return pairs.unionByName(unmatched, allowMissingColumns=True)


def _attach(target: DataFrame, source: DataFrame, spec: HistorySpec, coverage: str,
            tuning: JoinTuning) -> DataFrame:
    """Target rows next to what they overlap; ``KIND`` is NULL where nothing matched."""
    how = "inner" if coverage == "pairs" else "left"
    strategy = tuning.strategy
    if strategy == "broadcast":
        size = measured_bytes(_timeline(source, spec, coverage))
        strategy = "broadcast" if size <= tuning.broadcast_bytes else "split"

    hot, pairs_of_hot, usual_target = None, hot_pairs, target
    if strategy in ("split", "dyadic"):
        rows = target.count()
        usual_target = dealt(target, rows, *spec.keys)
        find = hot_keys if strategy == "split" else dyadic_keys
        hot = find(target, source, spec, tuning, rows)
    if strategy == "dyadic":
        pairs_of_hot = partial(dyadic_pairs, tuning=tuning)
    if hot is not None:
        usual = _timeline(without_hot(source, hot, spec), spec, coverage)
        cold = _join(without_hot(target, hot, spec), usual, spec, how, coverage)
        joined = cold.unionByName(
            _attach_hot(target, source, hot, spec, coverage, pairs_of_hot))
    elif strategy == "salted":
        joined = _join_salted(target, _timeline(source, spec, coverage), spec, how, coverage,
                              tuning.salt_buckets)
    else:
        timeline = _timeline(source, spec, coverage)
        joined = _join(usual_target, F.broadcast(timeline) if strategy == "broadcast" else timeline,
                       spec, how, coverage)
    return joined.where(F.col(KIND).isNull() | (F.col(KIND) != KEY))


def _clipped(joined: DataFrame, spec: HistorySpec, keep_unmatched: bool) -> DataFrame:
    """Clip to the intersection, recompute the flag, take the new values from the source.

    ``keep_unmatched``: rows without a match keep their stored flag and values.
    """
    start = F.greatest(F.col(spec.start), F.col(SRC_START))
    end = F.least(F.col(spec.end), F.col(SRC_END))
    flag = is_open(end, spec.open_date)
    values = {c: F.col(src_value(c)) for c in spec.new_cols}
    if keep_unmatched:
        stored = F.col(KIND).isNull()
        flag = F.when(stored, F.col(spec.active)).otherwise(flag)
        values = {c: F.when(stored, F.col(c)).otherwise(v) for c, v in values.items()}
    computed = {spec.start: start, spec.end: end, spec.active: flag, **values}
    # the output has the target's types, whatever the source's are
    return joined.select(*[
        computed[c].cast(joined.schema[c].dataType).alias(c) if c in computed else F.col(c)
        for c in spec.target_cols])


def overlap_pairs(target: DataFrame, source: DataFrame, spec: HistorySpec, how: str = "inner",
                  tuning: JoinTuning = JoinTuning()) -> DataFrame:
    """All overlapping (target, source) pairs with both windows as they are, unranked."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    return _attach(target, source, spec, "pairs" if how == "inner" else "left", tuning).drop(KIND)


def overlap_rows(target: DataFrame, source: DataFrame, spec: HistorySpec, how: str = "inner",
                 tuning: JoinTuning = JoinTuning()) -> DataFrame:
    """One row per overlapping (target, source) pair, clipped to the intersection.

    ``how="left"`` also keeps target rows without overlap, with their own dates, a recomputed
    flag and NULL new columns.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    joined = _attach(target, source, spec, "pairs" if how == "inner" else "left", tuning)
    return _clipped(joined, spec, keep_unmatched=False)


def expand_history(target: DataFrame, source: DataFrame, spec: HistorySpec,
                   coverage: str = "preserve", tuning: JoinTuning = JoinTuning()) -> DataFrame:
    """The whole new content of the target.

    inner     overlaps of covered keys, plus the unchanged rows of keys the source does not have;
              rows (or parts of rows) of covered keys outside the source's time are dropped
    left      overlaps, plus every target row without any overlap
    preserve  like inner, but the uncovered parts are kept as rows with NULL new columns, so no
              day of any key is lost
    """
    if coverage not in COVERAGE_MODES:
        raise ValueError(f"coverage must be one of {COVERAGE_MODES}")
    if coverage == "left":
        return overlap_rows(target, source, spec, "left", tuning)
    return _clipped(_attach(target, source, spec, coverage, tuning), spec, keep_unmatched=True)
