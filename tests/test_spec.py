"""Job spec and scans."""

import pytest

from chronofold.sources.history import lower_names, source_history, target_history
from chronofold.spec import HistorySpec, JoinTuning
from small import SPEC

BASE = dict(keys="id", passthrough="id,name,eff_start_date,eff_end_date,active", new_cols="status")


def test_text_and_sequences_are_equal():
    assert HistorySpec(**BASE) == HistorySpec(
        keys=["id"], passthrough=["id", "name", "eff_start_date", "eff_end_date", "active"],
        new_cols=("status",))
    spec = HistorySpec(**{**BASE, "keys": "id, name"})
    assert spec.keys == ("id", "name") and spec.carried == ()
    assert spec.source_cols == ("id", "name", "status", "eff_start_date", "eff_end_date")


@pytest.mark.parametrize("change", [
    {"keys": "id; drop table x"}, {"keys": ""}, {"new_cols": ""}, {"new_cols": "name"},
    {"passthrough": "name,eff_start_date,eff_end_date,active"}, {"open_date": "never"},
    {"new_cols": "_src_x"}, {"src_start": "a b"},
])
def test_bad_specs_are_refused(change):
    with pytest.raises(ValueError):
        HistorySpec(**{**BASE, **change})


@pytest.mark.parametrize("change", [{"strategy": "magic"}, {"salt_buckets": 0}])
def test_bad_tuning_is_refused(change):
    with pytest.raises(ValueError):
        JoinTuning(**change)


def test_target_scan_selects_and_casts(spark):
    raw = spark.sql("SELECT 'x' AS extra, 1L AS id, 'A' AS place, '2020-01-01' AS eff_start_date, "
                    "timestamp'2021-01-01 10:00:00' AS eff_end_date, 1 AS active, 's' AS status")
    scan = target_history(raw, SPEC)
    assert scan.columns == list(SPEC.target_cols)
    assert dict(scan.dtypes)["eff_start_date"] == dict(scan.dtypes)["eff_end_date"] == "date"


def test_source_scan_lowers_and_renames(spark):
    raw = spark.sql("SELECT 1L AS ID, 's' AS Status, '2020-01-01' AS EFF_START_DATE, "
                    "'2021-01-01' AS Eff_End_Date, 0 AS other")
    assert source_history(raw, SPEC).columns == ["id", "_src_status", "_src_start", "_src_end"]


def test_names_that_differ_in_case_only_are_refused(spark):
    with pytest.raises(ValueError, match="only in case"):
        lower_names(spark.range(1).toDF("id").selectExpr("id", "id AS ID"))
