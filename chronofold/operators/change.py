"""Change classification and the merge form of the back-fill, computed as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.functions.columns import all_of, any_of, differs
from chronofold.operators.membership import not_in
from chronofold.spec import HistorySpec


def _current(target: DataFrame, spec: HistorySpec, cols: Sequence[str]) -> DataFrame:
    """Stored rows under ``_cur_`` names, so they can sit next to staged rows."""
    return target.select(
        *[F.col(c).alias(f"_cur_{c}") for c in (*spec.keys, spec.start, *cols)],
        F.lit(True).alias("_stored"))


def _same_row(spec: HistorySpec):
    return all_of(F.col(c) == F.col(f"_cur_{c}") for c in (*spec.keys, spec.start))


def _changed(cols: Sequence[str]):
    return any_of(differs(F.col(c), F.col(f"_cur_{c}")) for c in cols)


def classify_changes(staged: DataFrame, target: DataFrame, spec: HistorySpec,
                     compare: Sequence[str] | None = None) -> DataFrame:
    """Tag staged rows INSERT, UPDATE or SAME against the stored row of equal key and start.

    ``compare`` defaults to the new columns. Adding the end date gives the rule by which
    ``merge_state`` decides to update.
    """
    compare = tuple(compare or spec.new_cols)
    action = (F.when(F.col("_stored").isNull(), "INSERT")
              .when(_changed(compare), "UPDATE")
              .otherwise("SAME"))
    return (
        staged.join(_current(target, spec, compare), _same_row(spec), "left")
        .select(*spec.target_cols, action.alias("cdc_action"))
    )


def action_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("cdc_action").agg(F.count("*").alias("row_count"))


def duplicate_starts(rows: DataFrame, spec: HistorySpec) -> DataFrame:
    """(key, start) pairs that occur more than once; a merge needs this to be empty.

    A NULL in a key or start never matches in a merge, so such rows are no repetition.
    """
    complete = all_of(F.col(c).isNotNull() for c in (*spec.keys, spec.start))
    return (rows.where(complete).groupBy(*spec.keys, spec.start).agg(F.count("*").alias("copies"))
            .where(F.col("copies") > 1))


def _merge(staged: DataFrame, target: DataFrame, spec: HistorySpec, how: str) -> DataFrame:
    """Staged rows with a unique (key, start) laid over the stored rows.

    The join is on key and start, so the rows of one key are spread over all its starts.
    """
    updatable = (spec.end, spec.active, *spec.new_cols)
    compared = (spec.end, *spec.new_cols)
    incoming = staged.withColumn("_staged", F.lit(True))
    joined = incoming.join(
        _current(target, spec, (spec.end, spec.active, *spec.carried, *spec.new_cols)),
        _same_row(spec), how)
    stored, new = F.col("_stored").isNotNull(), F.col("_staged").isNotNull()
    take_new = new & (~stored | _changed(compared))

    def value(c):
        if c in updatable:
            return F.when(take_new, F.col(c)).otherwise(F.col(f"_cur_{c}"))
        return F.when(stored, F.col(f"_cur_{c}")).otherwise(F.col(c))

    return joined.select(*[value(c).alias(c) for c in spec.target_cols])


def merge_state(staged: DataFrame, target: DataFrame, spec: HistorySpec) -> DataFrame:
    """The table after the upsert: matched rows updated if end or new columns differ, the other
    staged rows inserted, the other stored rows kept."""
    return _merge(staged, target, spec, "full_outer")


def backfilled_state(staged: DataFrame, target: DataFrame, spec: HistorySpec) -> DataFrame:
    """The table after the upsert and the removal of stale parents, from one join."""
    return _merge(staged, target, spec, "left")


def _staged_starts(staged: DataFrame, spec: HistorySpec):
    """Distinct staged (key, start) and the null-safe condition to join them on."""
    row_id = (*spec.keys, spec.start)
    starts = staged.select(*[F.col(c).alias(f"_cur_{c}") for c in row_id]).distinct()
    return starts, all_of(F.col(c).eqNullSafe(F.col(f"_cur_{c}")) for c in row_id)


def stale_parents(target: DataFrame, staged: DataFrame, spec: HistorySpec,
                  null_aware: bool = False) -> DataFrame:
    """Stored rows whose (key, start) no staged row has.

    NULLs compare as equal; with ``null_aware`` they compare as SQL's NOT IN does, so a NULL on
    either side keeps a row from being stale.
    """
    if null_aware:
        row_id = (*spec.keys, spec.start)
        return not_in(target, row_id, staged, row_id)
    return target.join(*_staged_starts(staged, spec), "left_anti")


def without_stale_parents(table: DataFrame, staged: DataFrame, spec: HistorySpec,
                          null_aware: bool = False) -> DataFrame:
    """Rows of ``table`` whose (key, start) is staged: what a delete of stale parents leaves.

    With ``null_aware`` also those that a NULL keeps from being stale.
    """
    if null_aware:
        row_id = (*spec.keys, spec.start)
        found = stale_parents(table, staged, spec, null_aware=True).select(
            *[F.col(c).alias(f"_cur_{c}") for c in row_id]).distinct()
        return table.join(found, all_of(F.col(c).eqNullSafe(F.col(f"_cur_{c}")) for c in row_id),
                          "left_anti")
    return table.join(*_staged_starts(staged, spec), "left_semi")
