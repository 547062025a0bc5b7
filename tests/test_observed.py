"""Counts taken while writing, and checks that read a run once."""

import pytest
from pyspark.sql import functions as F

from chronofold.operators import checks
from chronofold.plans import jobs
from chronofold.plans.jobs import ValidationFailed, run_merge, run_overwrite
from chronofold.sinks.publish import RunStore
from small import SPEC, source, target


@pytest.fixture
def tables(spark):
    t = target(spark, (1, "a", "2020-01-01", "2021-01-01"), (1, "b", "2021-01-01", "H"), (2, "c", "2020-01-01", "H"))
    return t, source(spark, (1, "X", "2020-01-01", "2020-06-01"), (1, "Y", "2020-06-01", "H"))


@pytest.mark.parametrize("run, args, nulls", [(run_overwrite, ["inner"], 1), (run_overwrite, ["preserve"], 1), (run_merge, [], 1)])
def test_counts_of_a_job_are_those_of_its_rows(spark, tmp_path, tables, run, args, nulls):
    store = RunStore(spark, str(tmp_path))
    result = run(*tables, SPEC, store, *args)
    rows = store.current().collect()
    assert (result.output_rows, result.null_rows, result.active_rows) == (len(rows), nulls, sum(r.active for r in rows))
    summary = store.latest(1).first().summary
    assert (summary["rows"], summary["null_rows"], summary["active_rows"]) == ("4", "1", "2")


def test_counts_of_nothing(spark, tmp_path, tables):
    store = RunStore(spark, str(tmp_path))
    result = run_overwrite(tables[0].where("false"), tables[1], SPEC, store)
    assert (result.output_rows, result.null_rows, result.active_rows, result.expansion_ratio) == (0, 0, 0, None)


def test_rows_that_do_not_arrive_are_noticed(spark, tmp_path, tables, monkeypatch):
    store = RunStore(spark, str(tmp_path))
    stage = jobs._stage

    def loses_a_row(final, spec, store):
        run_id, seen = stage(final, spec, store)
        return run_id, {**seen, "rows": seen["rows"] + 1}

    monkeypatch.setattr(jobs, "_stage", loses_a_row)
    with pytest.raises(ValidationFailed, match="5 rows written, 4 read"):
        run_overwrite(*tables, SPEC, store, ignore=checks.CHECKS)
    assert store.history().isEmpty()


def test_the_checked_table_is_computed_once(spark, tables):
    t, s = tables
    runs = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(x):
        runs.add(1)
        return x

    marked = t.withColumn("active", counted("active"))
    findings = checks.verdict_counts(t, marked, s, SPEC)
    assert findings.first().rows_after == 3
    assert runs.value == 3
