"""What grows with a table: tasks by its rows, copies by those that can match, histories derived once."""

import os

from pyspark.sql import functions as F

from chronofold import session
from chronofold.operators import checks, overlap
from chronofold.operators.overlap import expand_history
from chronofold.plans import catalogue
from chronofold.spec import JoinTuning
from small import EVERY_TUNING, SPEC, d, rows, source, target


def histories(spark, keys):
    t = target(spark, *[(k, "a", f"2020-0{m}-01", f"2020-0{m + 1}-01") for k in range(keys) for m in (1, 2, 3)])
    return t, source(spark, *[(k, "x", "2020-01-15", "2020-03-15") for k in range(0, keys, 2)])


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    t, s = histories(spark, 60)
    whole = expand_history(t, s, SPEC, "inner")
    want, gaps = rows(whole), sorted(checks.date_gaps(whole, SPEC).collect())
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.dealt(t, 180, "id").rdd.getNumPartitions() == t.rdd.getNumPartitions()
    monkeypatch.setattr(session, "ROWS_PER_TASK", 9)
    assert session.dealt(t, 180, "id").rdd.getNumPartitions() == 20 > most
    for name in ("split, nothing hot", "salted 5", "dyadic, all hot"):
        assert rows(expand_history(t, s, SPEC, "inner", EVERY_TUNING[name])) == want
    many = expand_history(t, s, SPEC, "inner")
    assert many.rdd.getNumPartitions() >= 20
    assert sorted(checks.date_gaps(many, SPEC).collect()) == gaps
    assert [x.passed for x in checks.verdict(t, many, s, SPEC).collect()] == [x.passed for x in checks.verdict(t, whole, s, SPEC).collect()]


def test_source_rows_are_repeated_only_where_their_key_has_rows(spark, monkeypatch):
    t, s = histories(spark, 20)
    seen = []
    join = overlap._join

    def counted(target, timeline, *rest):
        seen.append(timeline.where(F.col("_kind") == "row").count())
        return join(target, timeline, *rest)

    monkeypatch.setattr(overlap, "_join", counted)
    for mode in ("inner", "left", "preserve"):
        found = rows(expand_history(t, s, SPEC, mode, JoinTuning("salted", salt_buckets=50)))
        assert seen.pop() <= 3 * 10
        assert found == rows(expand_history(t, s, SPEC, mode, JoinTuning("plain")))
        seen.clear()


def test_histories_are_derived_from_their_events_once(spark, tmp_path):
    day = F.lit(d("2020-01-01"))
    spark.range(50).select(
        F.col("id").alias("event_id"), F.date_add(day, F.col("id").cast("int")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.when(F.col("id") % 2 == 0, "view").otherwise("purchase").alias("event_type"),
        F.lit(1.0).alias("value"), F.lit("{}").alias("props")).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    for history in catalogue._load("f2", spark, str(tmp_path))[:2]:
        assert history.count() > 0
        assert not any("events.parquet" in os.path.dirname(f) for f in history.inputFiles())
