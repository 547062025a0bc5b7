"""Every registered query against its SQL oracle, and the documented fixture counts."""

import functools

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from chronofold.operators.overlap import expand_history, overlap_rows
from chronofold.operators.coverage import covered_rows, uncovered_rows
from chronofold.operators import change
from chronofold.plans.catalogue import EVERY_KEY_HOT, all_queries
from chronofold.plans.oracles import all_oracles
from chronofold.sources.history import source_history, target_history
from chronofold.spec import JoinTuning
from compare import TABLES, difference, duck
from fixture_sql import FIXTURES

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@functools.cache
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


def test_every_query_is_registered():
    assert QUERIES.keys() <= contract.queries().keys() and ORACLES.keys() <= contract.oracle_sql().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 1499


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, name):
    assert difference(QUERIES[name](spark, SF), con(), ORACLES[name]) is None


# target, source, passthrough, inner overlap, left overlap, rows that vanish under inner (sf0.001)
COUNTS = {
    "f1": (1499, 592, 520, 1343, 1970, 107),
    "f2": (265, 65, 116, 127, 285, 42),
    "f3": (870, 609, 250, 1186, 1444, 8),
}


def histories(spark, name, sf_dir):
    spec, target_sql, source_sql = FIXTURES[name]

    def run(sql):
        return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
                                 for t in TABLES if f"{{{t}}}" in sql})

    return (target_history(run(target_sql), spec), source_history(run(source_sql), spec), spec)


@pytest.mark.parametrize("name", COUNTS)
def test_documented_counts(spark, name):
    t, s, spec = histories(spark, name, SF)
    n_target, n_source, passed, inner, left, vanished = COUNTS[name]
    assert (t.count(), s.count()) == (n_target, n_source)
    assert uncovered_rows(t, s, spec.keys).count() == passed
    assert covered_rows(t, s, spec.keys).count() == n_target - passed
    for tuning in (JoinTuning("plain"), EVERY_KEY_HOT):
        assert overlap_rows(t, s, spec, "inner", tuning).count() == inner
        assert overlap_rows(t, s, spec, "left", tuning).count() == left
        assert expand_history(t, s, spec, "inner", tuning).count() == inner + passed
    assert left == inner + vanished + passed
    staged = overlap_rows(t, s, spec, "left")
    assert change.duplicate_starts(staged, spec).isEmpty()
    assert change.backfilled_state(staged, t, spec).count() == left


def test_documented_days_and_changes(spark):
    """Figures of fixture F1 at sf0.01: preserve keeps every day, and the merge arithmetic."""
    t, s, spec = histories(spark, "f1", "/root/testdata/sf0.01")
    days = F.sum(F.datediff(spec.end, spec.start))
    kept = expand_history(t, s, spec).agg(F.count("*"), days).first()
    assert (t.agg(days).first()[0], *kept) == (824_167_047, 20_163, 824_167_047)
    staged = overlap_rows(t, s, spec, "left")
    actions = {r.cdc_action: r.row_count for r in change.action_counts(
        change.classify_changes(staged, t, spec)).collect()}
    assert actions["INSERT"] == 5_195
    assert change.stale_parents(t, staged, spec).count() == 634
    assert staged.count() == 14_968 - 634 + 5_195
