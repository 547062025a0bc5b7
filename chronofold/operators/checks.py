"""Data-quality checks of a history; each returns its findings as a DataFrame.

The row before a row (``LAG`` per key, ties on start ordered by end) is found without putting a
whole key into one task. Copies of a (key, start, end) are first combined map-side into one row
with a count. A key is then cut by the year of the start, and each year begins with a marker that
carries the last and the furthest end of all years before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.functions.columns import any_null
from chronofold.operators.coverage import source_keys
from chronofold.session import dealt, written
from chronofold.spec import HistorySpec

_COPIES_PER_ROW = 10_000
# Days are 32-bit numbers, so a start and an end fit into one long.
_NO_DAY, _DAY_RANGE = -2**31, 2**32


def _position(spec: HistorySpec) -> Column:
    """Place of a row in (start, end) order, NULLs first, as one number: its maximum needs no
    sort."""
    start, end = (F.coalesce(F.unix_date(d), F.lit(_NO_DAY)).cast("long")
                  for d in (spec.start, spec.end))
    return start * _DAY_RANGE + (end - _NO_DAY)


def _end_at(position: Column) -> Column:
    day = F.pmod(position, F.lit(_DAY_RANGE))
    return F.when(day > 0, F.date_from_unix_date((day + _NO_DAY).cast("int")))


def _neighbours(table: DataFrame, spec: HistorySpec) -> DataFrame:
    """Key, start, the end of the row before, the furthest end of all rows before, and how often.

    ``table`` is read once, when this is called.
    """
    windows = written(table.groupBy(*spec.keys, spec.start, spec.end).agg(
        F.count("*").alias("_copies")))
    return _linked(dealt(windows, windows.count(), *spec.keys), spec)


def _linked(windows: DataFrame, spec: HistorySpec) -> DataFrame:
    """``_neighbours`` of rows that are already combined by key, start and end, with ``_copies``."""
    keys, end = spec.keys, F.col(spec.end)
    windows = windows.withColumn("_year", F.year(spec.start))

    by_year = Window.partitionBy(*keys).orderBy("_year")
    years = windows.groupBy(*keys, "_year").agg(
        F.max(_position(spec)).alias("_position"), F.max(end).alias("_furthest"))
    markers = years.select(
        *keys, "_year",
        _end_at(F.lag("_position").over(by_year)).alias("_last"),
        F.max("_furthest").over(by_year.rowsBetween(Window.unboundedPreceding, -1))
        .alias("_furthest"))

    in_year = Window.partitionBy(*keys, "_year").orderBy(
        F.col("_copies").isNotNull(), spec.start, spec.end)
    linked = (
        windows.withColumns({"_last": end, "_furthest": end})
        .unionByName(markers, allowMissingColumns=True)
        .select(*keys, spec.start, spec.end, "_copies", F.struct(
            F.lag("_last").over(in_year).alias("_prev_end"),
            F.max("_furthest").over(in_year.rowsBetween(Window.unboundedPreceding, -1))
            .alias("_reach"),
            F.lit(1).cast("long").alias("_times")).alias("_before"))
        .where(F.col("_copies").isNotNull()))
    # Each further copy of a window comes right after a copy of itself.
    copies = F.struct(
        end.alias("_prev_end"),
        F.greatest("_before._reach", end).alias("_reach"),
        (F.col("_copies") - 1).alias("_times"))
    return linked.select(
        *keys, spec.start, F.inline(F.array("_before", copies))).where("_times > 0")


def _repeat(findings: DataFrame) -> DataFrame:
    """One row per occurrence; long runs are generated in chunks so no array grows with them."""
    chunks = F.sequence(F.lit(0).cast("long"),
                        F.floor((F.col("_times") - 1) / _COPIES_PER_ROW).cast("long"))
    in_chunk = F.least(F.lit(_COPIES_PER_ROW).cast("long"),
                       F.col("_times") - F.col("_chunk") * _COPIES_PER_ROW)
    return (
        findings
        .withColumn("_chunk", F.explode(chunks))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), in_chunk)))
        .drop("_times", "_chunk", "_copy")
    )


def _is_gap(spec: HistorySpec) -> Column:
    return F.col("_prev_end").isNotNull() & (F.col("_prev_end") != F.col(spec.start))


def _is_overlap(spec: HistorySpec, end: str) -> Column:
    return F.col(end).isNotNull() & (F.col(end) > F.col(spec.start))


def date_gaps(table: DataFrame, spec: HistorySpec) -> DataFrame:
    """Rows that do not start where the row before them ends (overlaps count as well)."""
    found = _neighbours(table, spec).where(_is_gap(spec))
    return _repeat(found.select(
        *spec.keys, F.col("_prev_end").alias("gap_from"), F.col(spec.start).alias("gap_to"),
        "_times"))


def date_overlaps(table: DataFrame, spec: HistorySpec, strict: bool = False) -> DataFrame:
    """Rows that start before the row before them ends; ``strict`` compares with the furthest end
    of all earlier rows, which also finds short rows inside a long one."""
    end = "_reach" if strict else "_prev_end"
    found = _neighbours(table, spec).where(_is_overlap(spec, end))
    return _repeat(found.select(
        *spec.keys, F.col(end).alias("overlap_end"), F.col(spec.start).alias("overlap_start"),
        "_times"))


def unexpected_nulls(table: DataFrame, source: DataFrame, spec: HistorySpec) -> DataFrame:
    """Number of rows with a NULL new column although their key is in the source.

    Counted per key before the semi join, so a key joins as one row whatever its size.
    """
    per_key = (table.where(any_null(spec.new_cols))
               .groupBy(*spec.keys).agg(F.count("*").alias("_rows")))
    return (per_key.join(source_keys(source, spec.keys), list(spec.keys), "left_semi")
            .agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("unexpected_null_count")))


def active_flag_findings(table: DataFrame, spec: HistorySpec, exactly_one: bool) -> DataFrame:
    """Keys with more than one active row, or, if ``exactly_one``, with any other number than 1."""
    active = F.col("active_count")
    return (table.groupBy(*spec.keys).agg(F.sum(spec.active).alias("active_count"))
            .where(active != 1 if exactly_one else active > 1))


def row_count_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before, rows after, and whether none were lost."""
    rows_before, rows_after = F.sum("_before"), F.sum("_after")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return (
        before.select(one.alias("_before"), none.alias("_after"))
        .unionAll(after.select(none, one))
        .agg(F.coalesce(rows_before, none).alias("rows_before"),
             F.coalesce(rows_after, none).alias("rows_after"))
        .withColumn("passed", F.col("rows_after") >= F.col("rows_before"))
    )


def covered_days(before: DataFrame, after: DataFrame, spec: HistorySpec) -> DataFrame:
    """Per key: days that the windows cover before and after, and those covered before only.

    The days lost are those of both tables together less those of ``after``. One sweep per key over the starts, which
    are combined map-side, so a group holds at most one row per calendar day. Rows without dates, or
    whose end is not after their start, cover nothing.
    """
    def windows(table: DataFrame, here: str, there: str) -> DataFrame:
        return table.where(F.col(spec.start) < F.col(spec.end)).select(
            *spec.keys, spec.start, F.col(spec.end).alias(here),
            F.lit(None).cast("date").alias(there))

    starts = (
        windows(before, "_before", "_after").unionByName(windows(after, "_after", "_before"))
        .groupBy(*spec.keys, spec.start).agg(F.max("_before").alias("_before"),
                                             F.max("_after").alias("_after"))
        .withColumn("_either", F.greatest("_before", "_after")))
    earlier = (Window.partitionBy(*spec.keys).orderBy(spec.start)
               .rowsBetween(Window.unboundedPreceding, -1))

    def new_days(end: str) -> Column:
        first = F.greatest(F.col(spec.start), F.max(end).over(earlier))
        return F.greatest(F.coalesce(F.date_diff(end, first), F.lit(0)), F.lit(0)).cast("long")

    swept = starts.select(*spec.keys, *[new_days(f"_{n}").alias(f"_{n}") for n in ("before", "after", "either")])
    days = swept.groupBy(*spec.keys).agg(
        F.sum("_before").alias("days_before"), F.sum("_after").alias("days_after"),
        (F.sum("_either") - F.sum("_after")).alias("days_lost"))
    return days


def lost_days(before: DataFrame, after: DataFrame, spec: HistorySpec) -> DataFrame:
    """Keys with days that were covered before and no longer are."""
    return covered_days(before, after, spec).where("days_lost > 0")


CHECKS = ("row_count", "date_gaps", "date_overlaps", "unexpected_nulls", "active_flags")


def verdict_counts(before: DataFrame, after: DataFrame, source: DataFrame, spec: HistorySpec,
                   exactly_one_active: bool = False) -> DataFrame:
    """One row with the row counts and the number of findings of every check.

    ``after`` is read once, when this is called: its rows, NULLs and flags are combined by key and
    window, and this narrow table is written to the shared folder for the checks per key and for
    the chain of dates. Keys meet the source keys as one row each.
    """
    active = F.col("_active")
    windows = written(after.groupBy(*spec.keys, spec.start, spec.end).agg(
        F.count("*").alias("_copies"),
        F.count(F.when(any_null(spec.new_cols), 1)).alias("_nulls"),
        F.sum(spec.active).alias("_active")))
    per_key = windows.groupBy(*spec.keys).agg(
        F.sum("_copies").alias("_rows"), F.sum("_nulls").alias("_nulls"),
        F.sum("_active").alias("_active"))
    known = source_keys(source, spec.keys).withColumn("_known", F.lit(True))
    content = per_key.join(known, list(spec.keys), "left").agg(
        F.sum("_rows").alias("rows_after"),
        F.sum(F.when(F.col("_known"), F.col("_nulls"))).alias("unexpected_nulls"),
        F.count(F.when(active != 1 if exactly_one_active else active > 1, 1))
        .alias("active_flags"))
    narrow = dealt(windows.select(*spec.keys, spec.start, spec.end, "_copies"), windows.count(), *spec.keys)
    chain = _linked(narrow, spec).agg(
        F.sum(F.when(_is_gap(spec), F.col("_times"))).alias("date_gaps"),
        F.sum(F.when(_is_overlap(spec, "_prev_end"), F.col("_times"))).alias("date_overlaps"))
    counts = (
        before.agg(F.count("*").alias("rows_before"))
        .unionByName(content, allowMissingColumns=True)
        .unionByName(chain, allowMissingColumns=True))
    rows, none = ("rows_before", "rows_after"), F.lit(0).cast("long")
    return (
        counts.agg(*[F.coalesce(F.sum(c), none).alias(c) for c in (*rows, *CHECKS[1:])])
        .withColumn("row_count", F.greatest(F.col("rows_before") - F.col("rows_after"), none))
    )


def verdict(before: DataFrame, after: DataFrame, source: DataFrame, spec: HistorySpec,
            exactly_one_active: bool = False) -> DataFrame:
    """All checks as rows (check_name, findings, passed)."""
    findings = [x for c in CHECKS for x in (F.lit(c), F.col(c))]
    return (
        verdict_counts(before, after, source, spec, exactly_one_active)
        .select(F.stack(F.lit(len(CHECKS)), *findings).alias("check_name", "findings"))
        .withColumn("passed", F.col("findings") == 0)
    )
