"""The dyadic overlap join: nodes of windows, bound of copies, many large keys."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from chronofold.operators import dyadic
from chronofold.operators.hot import only_hot
from chronofold.operators.overlap import expand_history, overlap_pairs
from chronofold.spec import JoinTuning
from small import DYADIC_ALL, EVERY_TUNING, SPEC, d, rows, source, target


def test_nodes_make_up_the_window_and_every_pair_meets_once(spark):
    for segments in (1, 2, 8, 32):
        windows = [(a, b) for a in range(segments) for b in range(a, segments)]
        frame = spark.createDataFrame([(*w, segments) for w in windows], "a int, b int, _segments int")
        found = frame.select("a", "b", dyadic.window_nodes(F.col("a"), F.col("b")).alias("window"),
                             dyadic.path_nodes(F.col("a")).alias("path")).collect()

        def leaves(node):
            width = segments >> (node.bit_length() - 1)
            first = (node - (1 << (node.bit_length() - 1))) * width
            return range(first, first + width)

        for r in found:
            assert sorted(x for n in r.window for x in leaves(n)) == list(range(r.a, r.b + 1))
            assert all(r.a in leaves(n) for n in r.path)
            assert max(len(r.window), len(r.path)) <= max(1, 2 * math.log2(segments))
            for o in found if segments < 32 else found[::7]:
                first = len(set(r.window) & set(o.path))
                second = len(set(r.path) & set(o.window)) if r.a > o.a else 0
                assert first + second == (max(r.a, o.a) <= min(r.b, o.b))


def many_windows(n, seed, open_ended):
    rng = random.Random(seed)
    days = [f"20{rng.randrange(10, 24)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 28):02}" for _ in range(n)]
    return [(1, f"r{i}", day, "H" if open_ended or rng.random() < 0.2
             else f"{int(day[:4]) + rng.randrange(3)}-12-31") for i, day in enumerate(days)]


def test_open_windows_on_both_sides_are_copied_on_few_nodes(spark):
    """With a segment for nearly every row, where a copy per segment would be hundreds a row."""
    t = target(spark, *many_windows(300, 1, True))
    s = source(spark, *many_windows(300, 2, True))
    tuning = JoinTuning("dyadic", hot_pairs=1, hot_rows=1, segment_rows=1)
    hot = dyadic.dyadic_keys(t, s, SPEC, tuning)
    segments = hot.plan.first()["_segments"]
    assert segments == 512
    for side, (start, end), is_target in ((t, ("eff_start_date", "eff_end_date"), True),
                                          (s, ("_src_start", "_src_end"), False)):
        placed = dyadic.on_nodes(only_hot(side, hot, SPEC), start, end, "_first", is_target)
        copies = placed.groupBy(F.xxhash64(*side.columns), F.col("_cell") > 0).count()
        assert copies.agg(F.max("count")).first()[0] <= 2 * math.log2(segments)
    assert overlap_pairs(t, s, SPEC, tuning=tuning).count() == 300 * 300
    wide = JoinTuning("dyadic", hot_pairs=1, hot_rows=1, segment_rows=1, cell_rows=2**31)
    assert dyadic.dyadic_keys(t, s, SPEC, wide).plan.first()["_t_salts"] == 1


def test_cells_of_many_pairs_are_divided(spark):
    t = target(spark, *many_windows(200, 3, False))
    s = source(spark, *many_windows(150, 4, False))
    whole = rows(expand_history(t, s, SPEC, "preserve", EVERY_TUNING["plain"]))
    for pairs in (1, 50):
        tuning = JoinTuning("dyadic", hot_pairs=1, hot_rows=1, segment_rows=10, cell_pairs=pairs)
        hot = dyadic.dyadic_keys(t, s, SPEC, tuning)
        cells = dyadic.heavy_cells(only_hot(t, hot, SPEC), only_hot(s, hot, SPEC),
                                   SPEC, tuning)
        counted = [dyadic._cell_rows(only_hot(side, hot, SPEC), SPEC, a, b, first, n)
                   for side, a, b, first, n in ((t, "eff_start_date", "eff_end_date", True, "t"),
                                                (s, "_src_start", "_src_end", False, "s"))]
        every = counted[0].join(counted[1], ["id", "_cell"]).join(cells, ["id", "_cell"], "left")
        for r in every.collect():
            a, b = r["_t_salts"] or 1, r["_s_salts"] or 1
            assert r.t * r.s <= pairs * a * b and a <= r.t and b <= r.s
        assert rows(expand_history(t, s, SPEC, "preserve", tuning)) == whole


def test_twenty_thousand_large_keys_are_split_by_a_table(spark, monkeypatch):
    days = spark.range(20_000).withColumnRenamed("id", "key")
    windows = days.select(
        F.col("key").alias("id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("n")).select(
        "id", "n", F.date_add(F.lit(d("2020-01-01")), F.col("n") * 20 + (F.col("id") % 7).cast("int")).alias("from"))
    t = windows.select("id", F.lit("x").alias("place"), F.col("from").alias("eff_start_date"),
                       F.date_add("from", 15).alias("eff_end_date"), F.lit(0).alias("active"),
                       F.lit(None).cast("string").alias("status"))
    s = windows.select("id", F.col("n").cast("string").alias("_src_status"),
                       F.date_add("from", 7).alias("_src_start"),
                       F.date_add("from", 20).alias("_src_end"))
    tuning = JoinTuning("dyadic", hot_pairs=10, segment_rows=1, max_hot_keys=5)
    from pyspark.sql.classic.dataframe import DataFrame
    hot = dyadic.dyadic_keys(t, s, SPEC, tuning)
    assert hot.plan.count() == 20_000 and hot.scan_filter is None

    collect = DataFrame.collect

    def at_most_one(self):
        rows = collect(self)
        assert len(rows) <= 1, "a list came to the driver"
        return rows

    with monkeypatch.context() as patch:
        patch.setattr(DataFrame, "collect", at_most_one)
        found = expand_history(t, s, SPEC, "left", tuning)
    plain = expand_history(t, s, SPEC, "left", EVERY_TUNING["plain"])
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()


@pytest.mark.parametrize("mode", ["inner", "left", "preserve"])
def test_null_and_inverted_dates(spark, mode):
    t = target(spark, (1, "a", None, "2020-01-01"), (1, "b", "2020-01-01", None), (None, "c", "2020-01-01", "H"),
               (1, "e", "2021-01-01", "2020-01-01"), (1, "f", "2019-01-01", "H"), (2, "g", "2019-01-01", "H"))
    s = source(spark, (1, "X", "2019-06-01", "2020-06-01"), (1, "Y", "2022-01-01", "2021-01-01"),
               (1, "Z", None, "2020-01-01"), (None, "N", "2020-01-01", "H"), (1, "O", "2023-01-01", "H"))
    assert rows(expand_history(t, s, SPEC, mode, DYADIC_ALL)) == rows(expand_history(t, s, SPEC, mode, EVERY_TUNING["plain"]))


def test_paths_hold_only_levels_on_which_windows_of_the_other_side_lie(spark):
    """Windows of one day and one that is open: nine levels a path, on which hardly a window lies."""
    days = [(1, f"r{i}", str(d("2020-01-01") + datetime.timedelta(i)), str(d("2020-01-01") + datetime.timedelta(i + 1)))
            for i in range(255)]
    t = target(spark, *days, (1, "last", "2020-09-12", "H"))
    s = source(spark, *days, (1, "last", "2020-09-12", "H"))
    tuning = JoinTuning("dyadic", hot_pairs=1, hot_rows=1, segment_rows=1)
    hot = dyadic.dyadic_keys(t, s, SPEC, tuning)
    assert hot.plan.first()["_segments"] == 256
    *sides, both = dyadic.with_levels(only_hot(t, hot, SPEC), only_hot(s, hot, SPEC), SPEC)
    placed = [dyadic.on_nodes(side, start, end, "_first", is_target).count() for side, start, end, is_target in (
        (sides[0], "eff_start_date", "eff_end_date", True), (sides[1], "_src_start", "_src_end", False))]
    assert both == 512 and max(placed) < 5 * 256
    plain = overlap_pairs(t, s, SPEC, tuning=EVERY_TUNING["plain"])
    found = overlap_pairs(t, s, SPEC, tuning=tuning)
    assert found.count() == plain.count() == 256 and found.exceptAll(plain).isEmpty()


def test_levels_of_a_window_are_those_of_its_nodes(spark):
    for segments in (1, 8, 64):
        windows = [(a, b, segments) for a in range(segments + 1) for b in range(max(a - 1, 0), segments)]
        found = spark.createDataFrame(windows, "a int, b int, _segments int").select(
            dyadic.window_nodes(F.col("a"), F.col("b")).alias("nodes"),
            dyadic.window_levels(F.col("a"), F.col("b") + 1).alias("levels")).collect()
        top = segments.bit_length()
        for r in found:
            assert r.levels == sum({1 << (top - n.bit_length()) for n in r.nodes})
