"""Overlap join for keys too large for one task, on a dyadic tree of time segments.

The time of a large key is cut into 2^L segments of equal width, the leaves of a binary tree. The intersection of two
windows begins in the first segment of one of them, and that segment lies within the other. So, in one way, a target
window lies on the O(L) tree nodes that together make up its segments, and a source window on the L + 1 nodes from
its first segment up to the root; they share exactly one node if the source window begins within the target window. In the
other way the roles change, for source windows that reach over the beginning of a target window from an earlier segment:
they lie on the nodes of the segments after their first. Every pair is met once, and a window is copied at most 2 L times
per way, however long or open it is. Nothing but windows that share time (up to the width of a segment) is compared. On
its path up to the root a window is put only on levels on which windows of its key's other side lie.

A cell (key, node) can still hold any number of pairs, as many windows may share much time. Rows are counted per cell
from a histogram of the windows' segments; a cell with more than ``cell_rows`` rows of a side or ``cell_pairs`` pairs
is divided by salts on both sides, in the proportion that copies the fewest rows.

The plan of the keys and that of the cells are tables, written once and joined. Neither passes the driver, and the
number of large keys has no limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.functions.columns import all_of, content_hash
from chronofold.operators.hot import (
    HotKeys, counted_keys, first_segment, last_segment, may_have_hot_keys)
from chronofold.session import dealt, written
from chronofold.sources.history import SRC_END, SRC_START
from chronofold.spec import HistorySpec, JoinTuning

_CELL, _T_CELLS, _S_CELLS = "_cell", "_t_salts", "_s_salts"
_T_LEVELS, _S_LEVELS = "_t_levels", "_s_levels"
#: Copies of a row, as measured, on nodes and in divided cells; only the number of tasks follows from it.
_COPIES = 3


def _shifted(way: str, number: Column, bits: Column) -> Column:
    return F.call_function(f"shift{way}", number, bits)


def dyadic_keys(target: DataFrame, source: DataFrame, spec: HistorySpec,
                tuning: JoinTuning, rows: int | None = None) -> HotKeys | None:
    """All large keys of the source with their tree, as a table; None if no key can be large."""
    if not may_have_hot_keys(target, source, spec, tuning, rows):
        return None
    wanted = F.greatest(F.lit(1), F.least(
        F.ceil(F.least("_t", "_s") / tuning.segment_rows), F.col("_days"),
        F.lit(tuning.max_segments)))
    leaves = _shifted("left", F.lit(1), F.ceil(F.log2(wanted.cast("double"))).cast("int"))
    rows_per_task = F.col("_segments") * F.lit(float(tuning.cell_rows))
    plan = (
        counted_keys(target, source, spec, tuning)
        .withColumn("_segments", leaves)
        .withColumn("_width", F.ceil(F.col("_days") / F.col("_segments")).cast("int"))
        # salts of the look-up of unmatched rows; the cells have their own
        .withColumn(_T_CELLS, F.ceil(F.col("_t") / rows_per_task).cast("int"))
        .withColumn(_S_CELLS, F.ceil(F.col("_s") / rows_per_task).cast("int"))
    )
    columns = [F.col(k).alias(f"_hot_{k}") for k in spec.keys]
    return HotKeys(written(plan.select(
        *columns, "_lo", "_width", "_segments", _T_CELLS, _S_CELLS)), None)


def _levels() -> Column:
    """0 for the leaves up to L for the root."""
    return F.sequence(F.lit(0), F.log2(F.col("_segments").cast("double")).cast("int"))


def _node(level: Column, place: Column) -> Column:
    """Nodes are numbered like a heap: the root is 1, the leaves are _segments and up."""
    return (_shifted("right", F.col("_segments"), level) + place).cast("int")


def window_nodes(first: Column, last: Column) -> Column:
    """The fewest nodes whose segments are those from ``first`` to ``last``: at most two of a level."""
    def of_level(level: Column) -> Column:
        width = _shifted("left", F.lit(1), level)
        low, high = F.ceil(first / width).cast("int"), F.floor((last + 1) / width).cast("int")
        left = F.when((low < high) & (low % 2 == 1), _node(level, low))
        right = F.when((low < high) & (high % 2 == 1), _node(level, high - 1))
        return F.array_compact(F.array(left, right))

    return F.flatten(F.transform(_levels(), of_level))


def window_levels(low: Column, high: Column) -> Column:
    """A bit for every level that ``window_nodes`` of the segments from ``low`` to before ``high`` lie on: the window
    is divided where the widest segments meet, and the parts' sizes are sums of the nodes' widths."""
    widest = F.floor(F.log2(low.bitwiseXOR(high).cast("double"))).cast("int")
    middle = _shifted("left", _shifted("right", high, widest), widest)
    return F.when(low < high, (middle - low).bitwiseOR(high - middle)).otherwise(0)


def path_nodes(first: Column, used: Column | None = None) -> Column:
    """The nodes from a segment up to the root; with ``used``, of the levels whose bit is set there."""
    wanted = _levels()
    if used is not None:
        wanted = F.filter(wanted, lambda level: _shifted("right", used, level) % 2 == 1)
    return F.transform(wanted, lambda level: _node(level, _shifted("right", first, level)))


def _window(start: str, end: str) -> tuple[Column, Column]:
    """First and last segment."""
    begin = first_segment(F.col(start))
    return begin, F.greatest(begin, last_segment(F.col(end)))


def _covered(first: Column, last: Column, is_target: bool) -> Column:
    """The nodes on which a window awaits beginnings of the other side. Windows that begin in the same segment meet
    on the target's nodes, so a source window awaits later segments only."""
    return window_nodes(first if is_target else first + 1, last)


def _nodes(rows: DataFrame, first: Column, last: Column, is_target: bool) -> Column:
    """Where a window lies; nodes of the second way are negative."""
    window, used = _covered(first, last, is_target), _S_LEVELS if is_target else _T_LEVELS
    path = path_nodes(first, F.col(used) if used in rows.columns else None)
    one, other = (window, path) if is_target else (path, window)
    return F.concat(one, F.transform(other, lambda node: -node))


def _levels_used(rows: DataFrame, spec: HistorySpec, start: str, end: str, is_target: bool,
                 name: str) -> DataFrame:
    """Per key, a bit for every level on which windows of a side lie."""
    first, last = _window(start, end)
    windows = rows.select(*spec.keys, (first if is_target else first + 1).alias("_low"), (last + 1).alias("_high"))
    return windows.groupBy(*spec.keys).agg(
        F.bit_or(window_levels(F.col("_low"), F.col("_high"))).alias(name), F.count("*").alias(f"{name}_rows"))


def with_levels(target: DataFrame, timeline: DataFrame,
                spec: HistorySpec) -> tuple[DataFrame, DataFrame, int]:
    """Both sides, of the keys that they share, with the levels on which windows of either side lie, and their rows."""
    used = written(
        _levels_used(target, spec, spec.start, spec.end, True, _T_LEVELS)
        .join(_levels_used(timeline, spec, SRC_START, SRC_END, False, _S_LEVELS), list(spec.keys)))
    counts = [f"{_T_LEVELS}_rows", f"{_S_LEVELS}_rows"]
    rows = used.agg(*map(F.sum, counts)).first()
    levels = used.drop(*counts)
    return target.join(levels, list(spec.keys)), timeline.join(levels, list(spec.keys)), sum(n or 0 for n in rows)


def on_nodes(rows: DataFrame, start: str, end: str, first: str, is_target: bool) -> DataFrame:
    """Rows with their first segment, repeated on their nodes."""
    begin, last = _window(start, end)
    placed = rows.withColumn(first, begin).withColumn("_last", last)
    nodes = _nodes(rows, F.col(first), F.col("_last"), is_target)
    return placed.withColumn(_CELL, F.explode(nodes)).drop("_last")


def _cell_rows(rows: DataFrame, spec: HistorySpec, start: str, end: str, is_target: bool,
               name: str) -> DataFrame:
    """Rows per cell, from a histogram of first and last segments."""
    first, last = _window(start, end)
    tree = [c for c in ("_segments", _T_LEVELS, _S_LEVELS) if c in rows.columns]
    histogram = (
        rows.select(*spec.keys, *tree, first.alias("_first"), last.alias("_last"))
        .groupBy(*spec.keys, *tree, "_first", "_last").agg(F.count("*").alias(name)))
    nodes = _nodes(rows, F.col("_first"), F.col("_last"), is_target)
    return (histogram.select(*spec.keys, name, F.explode(nodes).alias(_CELL))
            .groupBy(*spec.keys, _CELL).agg(F.sum(name).alias(name)))


def heavy_cells(target: DataFrame, timeline: DataFrame, spec: HistorySpec,
                tuning: JoinTuning) -> DataFrame:
    """Cells that must be divided, with the number of salts of both sides."""
    t, s = F.col("_t").cast("double"), F.col("_s").cast("double")
    parts = F.ceil(t * s / tuning.cell_pairs)
    t_salts = F.greatest(F.ceil(t / tuning.cell_rows), F.least(t, F.ceil(F.sqrt(parts * t / s))))
    s_salts = F.greatest(F.ceil(s / tuning.cell_rows), F.least(s, F.ceil(parts / F.col(_T_CELLS))))
    return (
        _cell_rows(target, spec, spec.start, spec.end, True, "_t")
        .join(_cell_rows(timeline, spec, SRC_START, SRC_END, False, "_s"), [*spec.keys, _CELL])
        .withColumn(_T_CELLS, t_salts.cast("int"))
        .withColumn(_S_CELLS, s_salts.cast("int"))
        .where((F.col(_T_CELLS) > 1) | (F.col(_S_CELLS) > 1))
        .select(*spec.keys, _CELL, _T_CELLS, _S_CELLS)
    )


def _salted(rows: DataFrame, cells: DataFrame | None, spec: HistorySpec, own: str, other: str,
            own_salt: str, other_salt: str, salt: Column) -> DataFrame:
    """One own salt, by content, and every salt of the other side; cells that are not divided have one."""
    if cells is None:
        return rows.withColumns({own_salt: F.lit(0), other_salt: F.lit(0)})

    def salts(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(1))

    return (
        rows.withColumn("_hash", salt).join(cells, [*spec.keys, _CELL], "left")
        .withColumn(own_salt, F.pmod("_hash", salts(own)).cast("int"))
        .withColumn(other_salt, F.explode(F.sequence(F.lit(0), salts(other) - 1)))
        .drop("_hash", _T_CELLS, _S_CELLS)
    )


def dyadic_pairs(target: DataFrame, timeline: DataFrame, spec: HistorySpec, meets: Column,
                 tuning: JoinTuning) -> DataFrame:
    """Every (target, timeline) pair of the large keys that ``meets``; both sides carry the key plan."""
    target, timeline, rows = with_levels(target, timeline, spec)
    cells = written(heavy_cells(target, timeline, spec, tuning))
    cells = None if cells.isEmpty() else cells
    plan = ("_lo", "_width", "_segments", _T_CELLS, _S_CELLS, _T_LEVELS, _S_LEVELS)
    left = on_nodes(target, spec.start, spec.end, "_first", True).drop(*plan)
    left = _salted(left, cells, spec, _T_CELLS, _S_CELLS, "_t_salt", "_s_salt",
                   content_hash(target, plan))
    left = dealt(left, _COPIES * rows, *spec.keys, _CELL, "_t_salt", "_s_salt")
    right = on_nodes(timeline, SRC_START, SRC_END, "_src_first", False).drop(*plan)
    right = _salted(right, cells, spec, _S_CELLS, _T_CELLS, "_src_s_salt", "_src_t_salt",
                    content_hash(timeline, plan))
    right = right.withColumnsRenamed(
        {_CELL: "_src_cell", **{k: f"_src_key_{k}" for k in spec.keys}})
    same_cell = all_of(
        [F.col(k) == F.col(f"_src_key_{k}") for k in spec.keys]
        + [F.col(c) == F.col(f"_src{c}") for c in (_CELL, "_t_salt", "_s_salt")])
    helpers = (_CELL, "_t_salt", "_s_salt", "_first")
    return left.join(right, same_cell & meets).drop(
        *helpers, *[f"_src{c}" for c in helpers], *[f"_src_key_{k}" for k in spec.keys])
