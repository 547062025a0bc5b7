"""The physical plans that the design relies on."""

import datetime as dt
import re
from contextlib import contextmanager

import pytest

from chronofold.operators import checks
from chronofold.operators.overlap import expand_history
from chronofold.sources.history import source_history, target_history
from chronofold.spec import JoinTuning
from small import H, SOURCE, SPEC, SPLIT_ALL, TARGET


@contextmanager
def conf(spark, **settings):
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Many rows without a key, so that one shuffle partition of the target is far too large."""
    folder = tmp_path_factory.mktemp("plans")
    day = dt.date(2020, 1, 1)
    rows = [(None if i % 3 else i, f"p{i}", day, H, 1, None) for i in range(6000)]
    (spark.createDataFrame(rows, TARGET).repartition(8).write
     .parquet(f"{folder}/target"))
    (spark.createDataFrame([(i, "X", day, H) for i in range(6000)], SOURCE).write
     .parquet(f"{folder}/source"))
    return (target_history(spark.read.parquet(f"{folder}/target"), SPEC),
            source_history(spark.read.parquet(f"{folder}/source"), SPEC))


SHUFFLED = dict(spark__sql__autoBroadcastJoinThreshold="-1",
                spark__sql__adaptive__autoBroadcastJoinThreshold="-1")


@pytest.mark.parametrize("mode", ["inner", "left", "preserve"])
def test_target_is_read_and_shuffled_once(spark, tables, mode):
    with conf(spark, **SHUFFLED):
        text = plan(expand_history(*tables, SPEC, mode))
    assert text.count("/target]") == 1
    assert len(re.findall(r"SortMergeJoin", text)) == 1
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Window" not in text.split("SortMergeJoin")[0]


def test_only_needed_columns_and_filters_reach_the_scan(spark, tables):
    with conf(spark, **SHUFFLED):
        text = plan(checks.date_gaps(tables[0], SPEC))
    assert "ReadSchema: struct<id:bigint,eff_start_date:date,eff_end_date:date>" in text
    with conf(spark, **SHUFFLED):
        text = plan(expand_history(tables[0].where("place = 'p7'"), tables[1], SPEC, "left",
                                   JoinTuning("plain")))
    assert "EqualTo(place,p7)" in text


def test_skewed_target_partition_is_split(spark, tables):
    small = {f"spark__sql__adaptive__{k}": v for k, v in {
        "skewJoin__skewedPartitionThresholdInBytes": "2KB",
        "skewJoin__skewedPartitionFactor": "1.5",
        "advisoryPartitionSizeInBytes": "2KB"}.items()}
    with conf(spark, **SHUFFLED, **small):
        out = expand_history(*tables, SPEC, "left", JoinTuning("plain"))
        assert out.count() == 6000
        out.collect()
        assert "skew=true" in plan(out)


def test_hot_way_has_no_cross_join(spark, tables):
    with conf(spark, **SHUFFLED):
        text = plan(expand_history(*tables, SPEC, "preserve", SPLIT_ALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_of_hot_rows_is_filtered_by_key(spark, tables):
    target, source = tables
    with conf(spark, **SHUFFLED):
        out = expand_history(target, source.where("id in (3, 6)"), SPEC, "left", SPLIT_ALL)
        scans = [line for line in plan(out).splitlines() if "/target]" in line]
    assert out.count() == 6000
    assert ["In(id, [" in line for line in scans].count(False) == 1
    assert any("In(id, [3,6])" in line or "In(id, [6,3])" in line for line in scans)
