"""The merge form and the overwrite script as SQL."""

import uuid

import pytest

from chronofold.operators import change
from chronofold.operators.overlap import expand_history, overlap_rows
from chronofold.plans.sql_form import merge_sql, overwrite_script, run_overwrite_script, staged_view
from small import SPEC, SOURCE, d, rows, source, target


def _case(spark):
    t = target(spark, (1, "Mumbai", "2018-11-19", "2023-02-13"),
               (2, "Pune", "2019-01-01", "H"), (3, "Goa", "2019-01-01", "H", "Z"),
               (4, "Agra", "2018-01-01", "2020-01-01"), (None, "Kochi", "2018-01-01", "H"),
               (5, "Surat", "2019-01-01", "H", "old"))
    s = source(spark, (1, "IS", "2018-11-19", "2021-09-28"), (1, "KS", "2021-09-28", "2023-03-13"),
               (3, "Z", "2010-01-01", "H"), (4, "Y", "2018-06-01", "2019-06-01"),
               (5, None, "2010-01-01", "H"))
    return t, s, overlap_rows(t, s, SPEC, "left")


def test_merge_as_sql_equals_the_dataframe_form(spark):
    t, _, staged = _case(spark)
    assert rows(merge_sql(staged, t, SPEC)) == rows(change.merge_state(staged, t, SPEC))
    assert rows(merge_sql(staged, t, SPEC, stale=False)) == rows(
        change.backfilled_state(staged, t, SPEC))
    for empty in (merge_sql(staged.limit(0), t, SPEC), merge_sql(t, t.limit(0), SPEC)):
        assert rows(empty) == rows(t)


def test_stored_values_stay_where_nothing_changed(spark):
    t = target(spark, (1, "stored", "2020-01-01", "2021-01-01", "X")).replace(0, 7, ["active"])
    staged = target(spark, (1, "staged", "2020-01-01", "2021-01-01", "X"))
    assert rows(merge_sql(staged, t, SPEC)) == rows(change.merge_state(staged, t, SPEC)) == [
        (1, "stored", "2020-01-01", "2021-01-01", 7, "X")]


def test_the_staged_view_lasts_as_long_as_its_block(spark):
    t, _, staged = _case(spark)
    with staged_view(staged) as name:
        assert spark.sql(f"SELECT COUNT(*) FROM {name}").first()[0] == staged.count()
    assert not spark.catalog.tableExists(name)


def test_overwrite_script(spark, tmp_path):
    t, s, _ = _case(spark)
    raw = spark.createDataFrame([(1, "IS", d("2018-11-19"), d("2021-09-28")),
                                 (1, "KS", d("2021-09-28"), d("2023-03-13"))], SOURCE)
    names = [f"script_{n}_{uuid.uuid4().hex}" for n in ("tgt", "src", "out", "none")]
    for name, df in zip(names, (t, raw, t, raw.limit(0)), strict=True):
        df.write.option("path", str(tmp_path / name)).saveAsTable(name)
    run_overwrite_script(spark, names[2], names[0], names[3], SPEC)
    assert rows(spark.table(names[2])) == rows(t)  # no source rows: nothing written
    run_overwrite_script(spark, names[2], names[0], names[1], SPEC)
    some = s.where("id = 1")
    assert rows(spark.table(names[2])) == rows(expand_history(t, some, SPEC, "inner"))
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_scripts_take_plain_names_only():
    with pytest.raises(ValueError):
        overwrite_script("a", "a", "b", SPEC)
    for bad in ("x'; DROP TABLE y", "x y", ""):
        with pytest.raises(ValueError):
            overwrite_script("out", bad, "b", SPEC)
