"""NOT IN over several columns by SQL's rule for NULL, as equi joins.

``(a, b) NOT IN (SELECT x, y ...)`` keeps a row if every comparison with the other side is false. A NULL compares
as unknown, so a row goes as soon as some other row equals it in all columns that are not NULL in either of them.
Spark plans such a condition as a nested loop over a broadcast of the other side.

Here both sides are told apart by their pattern, the set of columns that are not NULL. A row of pattern P and another
of pattern Q compare on the columns of both; for each set of columns there is one anti join, on equality of these
columns and of P. The other side is first reduced to the distinct values of each set, map-side. The set of no column
is the case of patterns that have nothing in common, such as an all-NULL row on either side: at most one row per
pattern, whatever the data, so that one is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.functions.columns import all_of

_PATTERN = "_pattern"


def _pattern(cols: Sequence[str]) -> Column:
    """Bit i is set if column i is not NULL."""
    bits = [F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(cols)]
    return sum(bits[1:], bits[0])


def _removers(among: DataFrame, n: int, shared: tuple[int, ...]) -> DataFrame:
    """Values of the columns ``shared``, with every pattern whose rows compare with them on just these."""
    mask = sum(1 << i for i in shared)
    met = [p for p in range(2 ** n) if p & mask == mask]
    of_pattern = F.filter(F.array(*[F.lit(p) for p in met]),
                          lambda p: p.bitwiseAND(F.col("_theirs")) == mask)
    return among.select(
        *[F.col(f"_other_{i}") for i in shared], F.explode(of_pattern).alias("_met")).distinct()


def not_in(rows: DataFrame, cols: Sequence[str], among: DataFrame,
           among_cols: Sequence[str]) -> DataFrame:
    """Rows whose ``cols`` are NOT IN ``among_cols`` of the other table, by SQL's rule.

    Nothing is dropped if the other table is empty, and everything if one of its rows is NULL in all
    columns.
    """
    if len(cols) != len(among_cols) or not cols:
        raise ValueError("as many columns are needed on one side as on the other, and at least one")
    taken = {c.lower() for c in rows.columns}
    if _PATTERN in taken or any(c.startswith("_other_") or c == "_met" for c in taken):
        raise ValueError("column names _pattern, _met and _other_... are reserved")
    n = len(cols)
    others = among.select(*[F.col(c).alias(f"_other_{i}") for i, c in enumerate(among_cols)])
    others = others.distinct().withColumn("_theirs", _pattern([f"_other_{i}" for i in range(n)]))
    kept = rows.withColumn(_PATTERN, _pattern(cols))
    for size in range(n, -1, -1):
        for shared in combinations(range(n), size):
            removers = _removers(others, n, shared)
            same = all_of([F.col(_PATTERN) == F.col("_met")]
                          + [F.col(cols[i]) == F.col(f"_other_{i}") for i in shared])
            kept = kept.join(removers if shared else F.broadcast(removers), same, "left_anti")
    return kept.drop(_PATTERN)
