"""The two whole back-fills: stage, check, then publish."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.functions.columns import any_null
from chronofold.operators.change import backfilled_state, duplicate_starts
from chronofold.operators.checks import CHECKS, lost_days, verdict_counts
from chronofold.operators.overlap import expand_history, overlap_rows
from chronofold.sinks.publish import RunStore, colocated
from chronofold.spec import HistorySpec, JoinTuning


#: A check of overwriting jobs, beside ``CHECKS``: no day that a key covered may be lost.
LOST_DAYS = "lost_days"


class ValidationFailed(RuntimeError):
    """A staged run did not pass; it was not published."""


@dataclass(frozen=True)
class JobResult:
    run_id: str
    input_rows: int
    output_rows: int
    findings: dict[str, int]
    #: rows without a value in some new column, and current rows, counted while writing
    null_rows: int = 0
    active_rows: int = 0

    @property
    def expansion_ratio(self) -> float | None:
        return self.output_rows / self.input_rows if self.input_rows else None


def _stage(final: DataFrame, spec: HistorySpec, store: RunStore) -> tuple[str, dict]:
    """Write a run, and count its rows on the way."""
    return store.stage_observed(final, {
        "rows": F.count(F.lit(1)),
        "null_rows": F.count(F.when(any_null(spec.new_cols), 1)),
        "active_rows": F.coalesce(F.sum(spec.active), F.lit(0))})


def _check_and_publish(run_id: str, seen: dict, target: DataFrame, source: DataFrame,
                       spec: HistorySpec, store: RunStore, operation: str,
                       ignore: Sequence[str]) -> JobResult:
    """Checks read the run once. The rows that they find must be those that were written."""
    written = store.read(run_id)
    counts = verdict_counts(target, written, source, spec).first()
    failed = [c for c in CHECKS if counts[c] and c not in ignore]
    if counts.rows_after != seen["rows"]:
        failed.append(f"{seen['rows']} rows written, {counts.rows_after} read")
    if operation == "overwrite" and LOST_DAYS not in ignore:
        keys, days = lost_days(target, written, spec).agg(
            F.count(F.lit(1)), F.coalesce(F.sum("days_lost"), F.lit(0))).first()
        if keys:
            failed.append(f"{LOST_DAYS}: {days} of {keys} keys")
    if failed:
        store.discard(run_id)
        raise ValidationFailed(f"run {run_id} not published, failed: {', '.join(failed)}")
    store.publish(run_id, operation, **seen)
    return JobResult(run_id, counts.rows_before, counts.rows_after,
                     {c: counts[c] for c in CHECKS}, seen["null_rows"], seen["active_rows"])


def run_overwrite(target: DataFrame, source: DataFrame, spec: HistorySpec, store: RunStore,
                  coverage: str = "preserve", tuning: JoinTuning = JoinTuning(),
                  ignore: Sequence[str] = (), colocate: bool = False) -> JobResult:
    """Back-fill by replacing the whole content.

    ``ignore`` names checks that may fail. Without "lost_days" there, a run by which a key loses
    days (as ``inner`` and ``left`` do, where the source does not cover them) is refused. The added uncovered pieces of ``preserve`` have NULL
    values by design, so ``unexpected_nulls`` is ignored there. A shuffled join leaves the rows of
    a key together already; ``colocate`` adds a shuffle that ensures it after other joins as well.
    """
    final = expand_history(target, source, spec, coverage, tuning)
    if coverage == "preserve":
        ignore = (*ignore, "unexpected_nulls")
    run_id, seen = _stage(colocated(final, spec.keys) if colocate else final, spec, store)
    return _check_and_publish(run_id, seen, target, source, spec, store, "overwrite", ignore)


def run_merge(target: DataFrame, source: DataFrame, spec: HistorySpec, store: RunStore,
              tuning: JoinTuning = JoinTuning(), ignore: Sequence[str] = ()) -> JobResult:
    """Back-fill by upsert and removal of stale parents; NULL values are not checked in this form.

    The left expansion is written once and read back by the duplicate check and the merge, so the
    overlap join runs once and a lost executor costs only its own tasks.
    """
    work = store.stage(overlap_rows(target, source, spec, "left", tuning))
    expanded = store.read(work)
    if not duplicate_starts(expanded, spec).isEmpty():
        store.discard(work)
        raise ValidationFailed("staged rows repeat a key and start date; the merge is ambiguous")
    run_id, seen = _stage(backfilled_state(expanded, target, spec), spec, store)
    store.discard(work)
    return _check_and_publish(run_id, seen, target, source, spec, store, "merge",
                              (*ignore, "unexpected_nulls"))
