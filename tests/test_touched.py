"""Merges that rewrite touched partitions only."""

import glob
import hashlib
import os

import pytest
from chronofold.operators.change import merge_state
from chronofold.sinks.publish import write_partitions
from chronofold.sinks.touched import _in_partitions, merge_touched, touched_partitions
from small import SPEC, rows, target


def files(path):
    found = glob.glob(f"{path}/**/*.parquet", recursive=True)
    return {f: (os.stat(f).st_mtime_ns, hashlib.md5(open(f, "rb").read()).hexdigest()) for f in found}


def stored_rows(spark):
    return target(spark, (1, "Delhi N", "2020-01-01", "2021-01-01"), (1, "Goa", "2021-01-01", "H"),
                  (2, "Pune", "2020-01-01", "H"), (3, "Goa", "2020-01-01", "H"), (4, None, "2020-01-01", "H"),
                  (5, "a/b+c%d", "2020-01-01", "H"))


def content(spark, path):
    return spark.read.schema(stored_rows(spark).schema).parquet(path).select(*SPEC.target_cols)


def test_other_partitions_keep_their_files(spark, tmp_path):
    path, before = str(tmp_path / "t"), stored_rows(spark)
    write_partitions(before, path, ["place"])
    old = files(path)
    # an update in Delhi (whose name holds a blank), a new row in Agra, one of an unchanged value in NULL
    staged = target(spark, (1, "Delhi N", "2020-01-01", "2020-06-01", "X"), (9, "Agra", "2020-01-01", "H", "Y"), (4, None, "2020-01-01", "H", "Z"))
    want = rows(merge_state(staged, before, SPEC))
    changed = merge_touched(staged, path, SPEC, ["place"])
    assert {r.place for r in changed.collect()} == {"Delhi N", "Agra", None}
    assert rows(content(spark, path)) == want
    new = files(path)
    same = {f for f in old if "Delhi" not in f and "HIVE_DEFAULT" not in f}
    assert len(same) >= 3 and all(new[f] == old[f] for f in same)
    assert not (set(old) - same) & set(new)


def test_a_partition_that_loses_its_rows_goes(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(stored_rows(spark), path, ["place"])
    staged = target(spark, (5, "Goa", "2020-03-01", "H", "S"), (3, "Goa", "2020-01-01", "H", "S"))
    merge_touched(staged, path, SPEC, ["place"], remove_stale=True)
    found = rows(content(spark, path))
    assert (5, "Goa", "2020-03-01", "H", 1, "S") in found and (3, "Goa", "2020-01-01", "H", 1, "S") in found
    assert [r[0] for r in found].count(5) == 1 and len(found) == 6
    assert not glob.glob(f"{path}/place=a*") and len(glob.glob(f"{path}/place=*")) == 4


def test_rows_move_between_partitions_of_an_updated_column(spark, tmp_path):
    path, before = str(tmp_path / "t"), stored_rows(spark)
    write_partitions(before, path, ["active"])
    staged = target(spark, (2, "Pune", "2020-01-01", "2022-01-01", "X"), (2, "Pune", "2022-01-01", "H", "Y"))
    want = rows(merge_state(staged, before, SPEC))
    merge_touched(staged, path, SPEC, ["active"])
    assert rows(content(spark, path)) == want


def test_only_touched_partitions_are_read_and_repeated_rows_are_refused(spark, tmp_path):
    path, before = str(tmp_path / "t"), stored_rows(spark)
    write_partitions(before, path, ["place", "active"])
    old = files(path)
    twice = target(spark, (2, "Pune", "2020-01-01", "H", "X"), (2, "Pune", "2020-01-01", "H", "Y"))
    with pytest.raises(ValueError, match="repeat"):
        merge_touched(twice, path, SPEC, ["place", "active"])
    assert files(path) == old
    assert merge_touched(before.where("false"), path, SPEC, ["place", "active"]).count() == 0
    assert files(path) == old
    staged = target(spark, (3, "Nashik", "2020-01-01", "H", "X"))
    found = touched_partitions(content(spark, path), staged, SPEC, ["place", "active"])
    assert {tuple(r) for r in found.collect()} == {("Goa", 1), ("Nashik", 1)}
    stored = spark.read.schema(before.schema).parquet(path)
    read = stored.where(_in_partitions(found.collect(), ["place", "active"]))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Goa" in plan[plan.index("PartitionFilters"):] and {r.place for r in read.collect()} == {"Goa"}
