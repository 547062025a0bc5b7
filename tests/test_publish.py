"""Run store, partition overwrite, SQL form and the two whole jobs."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from chronofold.operators.overlap import expand_history, overlap_rows
from chronofold.plans.jobs import ValidationFailed, run_merge, run_overwrite
from chronofold.plans.sql_form import backfill_sql, insert_overwrite_sql
from chronofold.session import work_folder
from chronofold.sinks.publish import RunStore, merge_into_catalog, write_partitions
from small import SOURCE, SPEC, d, rows, source, target


@pytest.fixture
def store(spark, tmp_path):
    return RunStore(spark, str(tmp_path / "store"))


def _history(spark):
    t = target(spark, (1, "Mumbai", "2018-11-19", "2023-02-13"), (1, "Goa", "2023-02-13", "H"),
               (2, "Pune", "2019-01-01", "H"))
    s = source(spark, (1, "IS", "2018-11-19", "2021-09-28"), (1, "KS", "2021-09-28", "H"))
    return t, s


def test_publish_rollback_expire(spark, store):
    with pytest.raises(ValueError):
        store.current()
    t, _ = _history(spark)
    runs = [store.stage(t.limit(n)) for n in (1, 2, 3)]
    with pytest.raises(ValueError):
        store.rollback(runs[0])
    for run in runs:
        store.publish(run, rows=1)
    assert store.current().count() == 3
    store.rollback(runs[0])
    assert store.current().count() == 1
    assert [r.operation for r in store.latest(5).collect()] == [
        "rollback", "overwrite", "overwrite", "overwrite"]
    assert store.latest(5).where("commit_no = 2").first().summary == {"rows": "1"}
    future = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1)
    assert store.expire(future - dt.timedelta(days=1), retain_last=1) == []
    assert set(store.expire(future, retain_last=2)) == {runs[1]}
    assert store.read(runs[2]).count() == 3 and store.current().count() == 1
    assert set(store.expire(future, retain_last=0)) == {runs[2]}
    assert store.current().count() == 1


def test_staged_run_is_invisible(spark, store):
    t, _ = _history(spark)
    store.publish(store.stage(t))
    store.stage(t.limit(1))
    assert store.current().count() == 3


def test_clustered_rewrite_sorts_across_files(spark, store):
    t = target(spark, *[(i % 7, "A", f"2020-01-{1 + i % 28:02d}", "H") for i in range(60)])
    store.publish(store.stage(t.repartition(3)))
    run = store.rewrite_clustered(["id", "eff_start_date"], rows_per_file=20)
    files = (store.read(run).withColumn("f", F.input_file_name()).groupBy("f")
             .agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n"))
             .orderBy("lo", "hi").collect())
    assert len(files) >= 3 and max(r.n for r in files) <= 20 + 20
    assert all(a.hi <= b.lo for a, b in zip(files, files[1:]))
    assert rows(store.current()) == rows(t)


def test_catalog_table_follows_the_current_run(spark, store):
    t, _ = _history(spark)
    name = f"t_{uuid.uuid4().hex}"
    first = store.stage(t)
    store.publish(first)
    store.point_table(name)
    assert spark.table(name).count() == 3
    store.publish(store.stage(t.limit(1)))
    store.point_table(name)
    assert spark.table(name).count() == 1
    store.rollback(first)
    store.point_table(name)
    assert spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_partition_overwrite_keeps_other_partitions(spark, tmp_path):
    t, _ = _history(spark)
    path = str(tmp_path / "parts")
    write_partitions(t, path, ["active"])
    write_partitions(t.where("active = 1 and id = 2"), path, ["active"])
    assert sorted((r.id, r.active) for r in spark.read.parquet(path).collect()) == [(1, 0), (2, 1)]


def test_sql_form_equals_dataframe_form(spark):
    t, s = _history(spark)
    raw = s.select("id", F.col("_src_status").alias("status"),
                   F.col("_src_start").alias("eff_start_date"),
                   F.col("_src_end").alias("eff_end_date"))
    assert rows(backfill_sql(spark, t, raw, SPEC)) == rows(expand_history(t, s, SPEC, "inner"))


def test_insert_overwrite_statement(spark, tmp_path):
    t, s = _history(spark)
    raw = spark.createDataFrame([(1, "IS", d("2018-11-19"), d("2021-09-28")),
                                 (1, "KS", d("2021-09-28"), d("H"))], SOURCE)
    names = [f"{n}_{uuid.uuid4().hex}" for n in ("tgt", "src", "out")]
    for name, df in zip(names, (t, raw, t)):
        df.write.option("path", str(tmp_path / name)).saveAsTable(name)
    insert_overwrite_sql(spark, names[2], names[0], names[1], SPEC)
    assert rows(spark.table(names[2])) == rows(expand_history(t, s, SPEC, "inner"))
    with pytest.raises(ValueError):
        insert_overwrite_sql(spark, names[0], names[0], names[1], SPEC)


def test_overwrite_job_publishes_a_valid_run(spark, store):
    t, s = _history(spark)
    result = run_overwrite(t, s, SPEC, store)
    assert (result.input_rows, result.output_rows) == (3, 4)
    assert result.expansion_ratio == pytest.approx(4 / 3)
    assert set(result.findings.values()) == {0}
    assert rows(store.current()) == rows(expand_history(t, s, SPEC))


def test_failed_checks_leave_the_published_state_alone(spark, store):
    t, s = _history(spark)
    run_overwrite(t, s, SPEC, store)
    before = rows(store.current())
    late = source(spark, (1, "X", "2030-01-01", "H"))
    with pytest.raises(ValidationFailed, match="row_count"):
        run_overwrite(t, late, SPEC, store, coverage="inner")
    assert rows(store.current()) == before


def test_rerun_with_the_same_source_changes_nothing(spark, store):
    t, s = _history(spark)
    run_overwrite(t, s, SPEC, store)
    once = rows(store.current())
    run_overwrite(store.current(), s, SPEC, store)
    assert rows(store.current()) == once


def test_merge_job_equals_left_expansion(spark, store):
    t, s = _history(spark)
    run_merge(t, s, SPEC, store)
    assert rows(store.current()) == rows(overlap_rows(t, s, SPEC, "left"))


def test_merge_job_refuses_ambiguous_rows(spark, store):
    t, _ = _history(spark)
    s = source(spark, (1, "X", "2010-01-01", "H"), (1, "Y", "2010-01-01", "H"))
    with pytest.raises(ValidationFailed, match="ambiguous"):
        run_merge(t, s, SPEC, store)


def test_catalog_merge_needs_a_catalog_with_row_level_changes(spark):
    t, s = _history(spark)
    name = f"t_{uuid.uuid4().hex}"
    t.write.saveAsTable(name)
    with pytest.raises(UnsupportedOperationException, match="MERGE INTO TABLE"):
        merge_into_catalog(overlap_rows(t, s, SPEC, "left"), name, SPEC)


def test_merge_job_leaves_only_its_run_behind(spark, store, tmp_path):
    t, s = _history(spark)
    result = run_merge(t, s, SPEC, store)
    assert os.listdir(tmp_path / "store" / "run") == [result.run_id]


def test_colocated_run_has_the_same_rows(spark, store):
    t, s = _history(spark)
    run_overwrite(t, s, SPEC, store, colocate=True)
    assert rows(store.current()) == rows(expand_history(t, s, SPEC))


def test_work_folder_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = work_folder(spark), work_folder(spark)
    assert a.startswith(shared) and a != b


def test_partition_values_keep_their_type_and_place(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "typed"))
    df = spark.createDataFrame([("007", 1), ("8", 2), (None, 3)], "place string, id long")
    found = store.read(store.stage(df, partition_by=["place"]))
    assert found.schema == df.schema and sorted(found.collect(), key=str) == sorted(df.collect(), key=str)
