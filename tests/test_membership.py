"""NOT IN over several columns against the rule of SQL, row by row."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from chronofold.operators.change import stale_parents, without_stale_parents
from chronofold.operators.membership import not_in
from small import SPEC, rows, target


def by_hand(left, right):
    def false(a, b):
        return any(x is not None and y is not None and x != y for x, y in zip(a, b))

    return sorted((x for x in left if all(false(x, y) for y in right)), key=str)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_all_patterns_of_nulls(spark, n):
    values = list(itertools.product([None, 1, 2], repeat=n))
    names = [f"c{i}" for i in range(n)]
    schema = ", ".join(f"{c} int" for c in names)
    rng = random.Random(n)
    cases = [[], [v for v in values if None not in v][:2], [(None,) * n]]
    cases += [rng.sample(values, k) for k in (1, 1, 2, 2, 3) if k < len(values)]
    left = spark.createDataFrame(values + values[:3], schema)
    for right in cases:
        others = spark.createDataFrame(right + right, schema).toDF(*[f"o{i}" for i in range(n)])
        found = not_in(left, names, others, others.columns)
        assert found.columns == names
        assert sorted(map(tuple, found.collect()), key=str) == by_hand(values + values[:3], right), right


def test_no_nested_loop_but_for_the_patterns(spark):
    left, right = (spark.createDataFrame([(1, 2), (None, 3)], "id long, b long") for _ in range(2))
    plan = not_in(left, ["id", "b"], right, ["id", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_columns_of_clashing_names_and_wrong_numbers(spark):
    left = spark.createDataFrame([(1, "k"), (None, "l")], "a int, _theirs string")
    assert [r.a for r in not_in(left, ["a"], left.where("a = 2"), ["a"]).collect()] == [1, None]
    for bad in (lambda: not_in(left, ["a"], left, []), lambda: not_in(left, [], left, []),
                lambda: not_in(left.withColumn("_met", F.lit(1)), ["a"], left, ["a"])):
        with pytest.raises(ValueError):
            bad()


def test_stale_parents_by_either_rule(spark):
    t = target(spark, (1, "a", "2020-01-01", "H"), (2, "b", "2020-01-01", "H"), (3, "c", None, "H"), (None, "d", "2021-01-01", "H"))
    staged = target(spark, (1, "a", "2020-01-01", "H"))
    assert [r[1] for r in rows(stale_parents(t, staged, SPEC))] == ["b", "c", "d"]
    assert [r[1] for r in rows(stale_parents(t, staged, SPEC, null_aware=True))] == ["b", "c", "d"]
    unknown = staged.unionByName(target(spark, (3, "x", "2020-01-01", "H"), (None, "y", "2020-01-01", "H")))
    assert [r[1] for r in rows(stale_parents(t, unknown, SPEC, null_aware=True))] == ["d"]
    assert [r[1] for r in rows(without_stale_parents(t, unknown, SPEC, null_aware=True))] == ["a", "b", "c"]
    assert [r[1] for r in rows(without_stale_parents(t, staged, SPEC))] == ["a"]
