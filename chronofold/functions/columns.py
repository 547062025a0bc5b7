"""Column expressions; all of them stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Half-open windows [a_start, a_end) and [b_start, b_end) share time; touching ones do not."""
    return (b_start < a_end) & (b_end > a_start)


def is_open(end: Column, open_date: str) -> Column:
    """1 for the current (open-ended) row, else 0."""
    return F.when(end == F.lit(open_date).cast("date"), 1).otherwise(0)


def all_of(conditions) -> Column:
    return reduce(and_, conditions)


def any_of(conditions) -> Column:
    return reduce(or_, conditions)


def any_null(cols) -> Column:
    return any_of(F.col(c).isNull() for c in cols)


def differs(left: Column, right: Column) -> Column:
    """Null-aware inequality (IS DISTINCT FROM)."""
    return ~left.eqNullSafe(right)


def content_hash(rows: DataFrame, without: Sequence[str] = ()) -> Column:
    """Hash of a row's content (maps and variants, which Spark cannot hash, are left out). The same
    row gets the same hash however often its task runs."""
    hashed = [f.name for f in rows.schema if f.name not in without
              and not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    return F.xxhash64(*hashed)


def divisible_only_by(number: Column, divisor: int, excluded: int) -> Column:
    """Multiples of ``divisor`` that are not multiples of ``excluded``."""
    return (number % divisor == 0) & (number % excluded != 0)


def swapped_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", last, first)


def sphere_volume(diameter: Column) -> Column:
    return F.lit(4.0) / 3 * F.pi() * F.pow(diameter / 2, F.lit(3.0))
