"""Compaction by bytes: small files are merged, all others keep their bytes."""

import datetime as dt
import glob
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from chronofold.sinks import compaction
from chronofold.sinks.compaction import small_file_groups
from chronofold.sinks.publish import RunStore


@pytest.fixture
def store(spark, tmp_path):
    return RunStore(spark, str(tmp_path))


def files(store):
    """Every data file of the store, with its size and a digest of its bytes."""
    found = glob.glob(f"{store.base}/run/**/*.parquet", recursive=True)
    return {f: (os.path.getsize(f), hashlib.md5(open(f, "rb").read()).hexdigest()) for f in found}


def used(store):
    return {"/" + f.split(":", 1)[1].lstrip("/") for f in
            [r.file_path for r in store.census().select(compaction.path_of("file_path").alias("file_path")).collect()]}


def some_rows(spark, n, name="a b+c%d/e", parts=1, first=0):
    return spark.range(first, first + n, 1, parts).select(
        "id", F.lit(name).alias("part"), F.sha2(F.col("id").cast("string"), 256).alias("text"))


def test_small_files_are_merged_and_others_keep_their_bytes(spark, store):
    rows = some_rows(spark, 3000, parts=1).unionByName(some_rows(spark, 500, parts=10, first=3000))
    first = store.stage(rows)
    store.publish(first)
    before, limit = files(store), 50_000
    small = {f for f, (size, _) in before.items() if size < limit}
    assert len(small) == 10 and len(before) == 11
    new = store.compact(limit, 500_000, ["id"])
    after = files(store)
    assert {f: after[f] for f in before} == before
    assert used(store) & set(before) == set(before) - small
    assert len(used(store)) == 2
    assert sorted(map(tuple, store.current().collect())) == sorted(map(tuple, rows.collect()))
    merged = spark.read.parquet(store.path(new)).collect()
    assert [r.id for r in merged] == list(range(3000, 3500))
    entry = store.latest(1).first()
    assert (entry.operation, entry.summary["rows"], entry.summary["merged_files"], entry.summary["keeps"]) == ("compact", "3500", "10", first)
    assert store.compact(limit, 500_000) is None and not os.path.exists(f"{store.base}/work/{new}")


def test_partitions_with_odd_names_and_files_of_several_runs(spark, store):
    rows = some_rows(spark, 900, "x y", 9).unionByName(some_rows(spark, 600, "a+b%c/d", 6, 900)).unionByName(
        some_rows(spark, 50, None, 1, 1500))
    want = sorted(map(tuple, rows.select("id", "part").collect()), key=str)
    store.publish(store.stage(rows, partition_by=["part"]))
    largest = max(size for size, _ in files(store).values())
    store.compact(largest + 1, 3 * largest)
    assert len(used(store)) < 16
    runs = {f.split("/run/")[1].split("/")[0] for f in used(store)}
    assert len(runs) == 2  # the lone file of the NULL partition stays where it is
    assert sorted(map(tuple, store.current().select("id", "part").collect()), key=str) == want
    store.compact(10**9, 10**9)  # merges files of the compacted run
    assert len(used(store)) == 3
    assert sorted(map(tuple, store.current().select("id", "part").collect()), key=str) == want
    with pytest.raises(ValueError, match="several folders"):
        store.point_table("nowhere")


def test_a_run_whose_files_are_kept_does_not_expire(spark, store):
    kept = store.stage(some_rows(spark, 2000).unionByName(some_rows(spark, 40, parts=4, first=2000)))
    store.publish(kept)
    gone = store.stage(some_rows(spark, 5))
    store.publish(gone)
    store.rollback(kept)
    store.compact(20_000, 10**6)
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=1)
    assert store.expire(later, retain_last=1) == [gone]
    assert store.current().count() == 2040


def test_groups_are_of_about_the_target_size(spark, monkeypatch):
    sizes = [(f"/t/p={i % 3}/f{i}", (i * 37) % 90 + 1, 1) for i in range(200)] + [("/t/p=9/alone", 5, 1), ("/t/p=0/big", 100, 1)]
    census = spark.createDataFrame(sizes, "file_path string, file_size long, row_count long")
    for chunk in (4096, 7):
        monkeypatch.setattr(compaction, "CHUNK", chunk)
        found = small_file_groups(census, 100, 300).join(census, "file_path")
        groups = found.groupBy("_group").agg(F.sum("file_size").alias("size"), F.count("*").alias("n"), F.count_distinct(F.substring("file_path", 1, 6)).alias("dirs")).collect()
        assert all(g.size < 400 and g.n > 1 and g.dirs == 1 for g in groups)
        names = {r.file_path for r in found.collect()}
        assert "/t/p=9/alone" not in names and "/t/p=0/big" not in names
        if chunk == 4096:
            assert len(names) >= 195 and sum(g.size > 200 for g in groups) >= len(groups) - 3
    with pytest.raises(ValueError):
        small_file_groups(census, 300, 100)


def test_nothing_published_yet(store):
    with pytest.raises(ValueError):
        store.compact(1, 1)


def test_a_store_below_a_folder_that_is_named_like_its_own(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "run" / "shared" / "run" / "x=1"))
    rows = some_rows(spark, 900, "x y", 9).unionByName(some_rows(spark, 600, "z", 6, 900))
    first = store.stage(rows, partition_by=["part"])
    store.publish(first)
    largest = max(size for size, _ in files(store).values())
    new = store.compact(largest + 1, 3 * largest, ["id"])
    assert sorted(map(tuple, store.current().select("id", "part").collect())) == sorted(map(tuple, rows.select("id", "part").collect()))
    assert {r.run_id for r in spark.read.parquet(store._kept(new)).collect()} <= {first}
    plain = store.stage(some_rows(spark, 500, parts=10))
    store.publish(plain)
    store.compact(10**6, 10**7)
    assert len(used(store)) == 1 and store.current().count() == 500
