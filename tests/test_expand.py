"""Expansion on hand-written histories, and equality of all join strategies."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronofold.operators.coverage import covered_rows, source_gaps, uncovered_rows
from chronofold.operators.overlap import (
    expand_history, measured_bytes, overlap_pairs, overlap_rows)
from small import EVERY_TUNING, d, H, SOURCE, SPEC, SPLIT_ALL, TARGET, rows, source, target
from chronofold.sources.history import source_history, target_history
from chronofold.spec import HistorySpec

MODES = ("inner", "left", "preserve")


def expand(t, s, mode, tuning="plain"):
    return rows(expand_history(t, s, SPEC, mode, EVERY_TUNING[tuning]))


def test_worked_example(spark):
    t = target(spark, (101, "Mumbai", "2018-11-19", "2023-02-13"))
    s = source(spark, (101, "IS", "2018-11-19", "2021-09-28"),
               (101, "KS", "2021-09-28", "2023-03-13"))
    want = [(101, "Mumbai", "2018-11-19", "2021-09-28", 0, "IS"),
            (101, "Mumbai", "2021-09-28", "2023-02-13", 0, "KS")]
    for mode in MODES:
        assert expand(t, s, mode) == want


def test_key_without_source_passes_through_with_stored_values(spark):
    t = target(spark, (107, "Pune", "2019-01-01", "H", "kept"))
    s = source(spark, (1, "X", "2019-01-01", "H"))
    whole = [(107, "Pune", "2019-01-01", "H", 1, "kept")]
    assert expand(t, s, "inner") == expand(t, s, "preserve") == whole
    assert expand(t, s, "left") == [(107, "Pune", "2019-01-01", "H", 1, None)]


def test_covered_key_without_overlap(spark):
    t = target(spark, (108, "Goa", "2010-01-01", "2012-01-01"))
    s = source(spark, (108, "X", "2015-01-01", "H"))
    whole = [(108, "Goa", "2010-01-01", "2012-01-01", 0, None)]
    assert expand(t, s, "inner") == []
    assert expand(t, s, "left") == expand(t, s, "preserve") == whole


def test_partly_covered_row(spark):
    t = target(spark, (109, "Agra", "2018-01-01", "2020-01-01"))
    s = source(spark, (109, "Y", "2018-06-01", "2019-06-01"))
    middle = (109, "Agra", "2018-06-01", "2019-06-01", 0, "Y")
    assert expand(t, s, "inner") == expand(t, s, "left") == [middle]
    assert expand(t, s, "preserve") == [
        (109, "Agra", "2018-01-01", "2018-06-01", 0, None), middle,
        (109, "Agra", "2019-06-01", "2020-01-01", 0, None)]


def test_touching_windows_do_not_overlap(spark):
    t = target(spark, (110, "A", "2020-01-01", "2021-01-01"))
    s = source(spark, (110, "X", "2019-01-01", "2020-01-01"))
    assert rows(overlap_rows(t, s, SPEC)) == []


def test_open_on_both_sides_stays_active(spark):
    t = target(spark, (111, "A", "2020-01-01", "H"))
    s = source(spark, (111, "X", "2020-01-01", "H"))
    assert expand(t, s, "inner") == [(111, "A", "2020-01-01", "H", 1, "X")]


def test_overlapping_source_windows_keep_all_pairs(spark):
    t = target(spark, (112, "A", "2020-01-01", "H"))
    s = source(spark, (112, "X", "2020-01-01", "2022-01-01"), (112, "Y", "2021-01-01", "H"))
    assert expand(t, s, "preserve") == [
        (112, "A", "2020-01-01", "2022-01-01", 0, "X"), (112, "A", "2021-01-01", "H", 1, "Y")]


def test_null_keys_never_match(spark):
    t = target(spark, (None, "A", "2020-01-01", "H"))
    s = source(spark, (None, "X", "2020-01-01", "H"))
    for mode in MODES:
        assert expand(t, s, mode) == [(None, "A", "2020-01-01", "H", 1, None)]


def test_null_end_overlaps_nothing(spark):
    t = target(spark, (115, "A", "2020-01-01", None))
    s = source(spark, (115, "X", "2020-01-01", "H"))
    assert expand(t, s, "inner") == []
    for tuning in ("plain", "split, all hot"):
        assert len(expand(t, s, "left", tuning)) == len(expand(t, s, "preserve", tuning)) == 1


def test_pairs_show_both_windows(spark):
    t = target(spark, (1, "A", "2020-01-01", "2021-01-01"))
    s = source(spark, (1, "X", "2019-01-01", "2020-06-01"))
    pair = overlap_pairs(t, s, SPEC).first()
    assert (str(pair.eff_end_date), str(pair._src_start)) == ("2021-01-01", "2019-01-01")


def test_coverage_split_is_a_partition(spark):
    t = target(spark, (1, "A", "2020-01-01", "H"), (2, "B", "2020-01-01", "H"),
               (None, "C", "2020-01-01", "H"))
    s = source(spark, (1, "X", "2019-01-01", "2020-01-01"), (1, "Y", "2020-01-01", "H"))
    assert [r.id for r in covered_rows(t, s, SPEC.keys).collect()] == [1]
    assert {r.id for r in uncovered_rows(t, s, SPEC.keys).collect()} == {2, None}


def test_gaps_complete_the_source_to_the_calendar(spark):
    s = source(spark, (1, "X", "2000-01-01", "2010-01-01"), (1, "Y", "2005-01-01", "2006-01-01"),
               (1, "Z", "2011-01-01", "2012-01-01"))
    found = sorted((str(r._src_start), str(r._src_end)) for r in source_gaps(s, ["id"]).collect())
    assert found == [("2010-01-01", "2011-01-01"), ("2012-01-01", "None"), ("None", "2000-01-01")]


def test_measured_bytes_counts_text(spark):
    short = source(spark, (1, "x", "2020-01-01", "H"))
    long = source(spark, (1, "x" * 1001, "2020-01-01", "H"))
    assert measured_bytes(long) - measured_bytes(short) == 1000
    assert measured_bytes(short.limit(0)) == 0


def _messy(seed, sides=(60, 60), keys=(1, 1, 1, 1, 2, 3, None)):
    """Overlapping, repeated, empty, inverted and NULL windows, most of them of one key."""
    rng = random.Random(seed)
    day = dt.date(2020, 1, 1)

    def window():
        start = day + dt.timedelta(rng.randrange(60))
        end = rng.choice([H, None] + [start + dt.timedelta(n) for n in (0, 1, 2, 5, 9, 30)] * 2)
        return (start if rng.random() > .05 else None), end

    def make(n, build):
        made = [build(rng.choice(keys), *window()) for _ in range(n)]
        return made + rng.sample(made, n // 5)

    t = make(sides[0], lambda k, a, b: (k, rng.choice("AB"), a, b, int(b == H), None))
    s = make(sides[1], lambda k, a, b: (k if k != 3 else 4, rng.choice("XY"), a, b))
    return t, s


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("seed", [1, 2])
def test_strategies_agree_on_messy_histories(spark, mode, seed):
    t_rows, s_rows = _messy(seed)
    t = target_history(spark.createDataFrame(t_rows, TARGET), SPEC)
    s = source_history(spark.createDataFrame(s_rows, SOURCE), SPEC)
    want = expand(t, s, mode, "plain")
    for name in EVERY_TUNING:
        assert expand(t, s, mode, name) == want, name


@pytest.mark.parametrize("seed", [3, 4])
def test_overlaps_match_brute_force(spark, seed):
    t_rows, s_rows = _messy(seed)
    t = target_history(spark.createDataFrame(t_rows, TARGET), SPEC)
    s = source_history(spark.createDataFrame(s_rows, SOURCE), SPEC)
    inner, left = Counter(), Counter()
    for k, place, a, b, _, _ in t_rows:
        hits = [(x, f, e) for sk, x, f, e in s_rows
                if None not in (k, a, b, f, e) and sk == k and f < b and e > a]
        for x, f, e in hits:
            inner[(k, place, max(a, f), min(b, e), int(min(b, e) == H), x)] += 1
        if not hits:
            left[(k, place, a, b, int(b == H), None)] += 1
    for tuning in (EVERY_TUNING["plain"], SPLIT_ALL):
        assert Counter(map(tuple, overlap_rows(t, s, SPEC, "inner", tuning).collect())) == inner
        assert Counter(map(tuple, overlap_rows(t, s, SPEC, "left", tuning).collect())) \
            == inner + left


@pytest.mark.parametrize("tuning", ["plain", "split, all hot"])
def test_preserve_conserves_days(spark, tuning):
    t_rows, s_rows = _messy(5)
    t_rows = [r for r in t_rows if None not in r[2:4] and r[2] < r[3]]
    # A source without overlaps, so that every day of a target row belongs to one piece.
    s_rows = [(1, "X", dt.date(2020, 1, 5), dt.date(2020, 1, 9)),
              (1, "Y", dt.date(2020, 1, 9), dt.date(2020, 1, 20)),
              (2, "Z", dt.date(2020, 2, 1), dt.date(2020, 2, 2))]
    t = target_history(spark.createDataFrame(t_rows, TARGET), SPEC)
    s = source_history(spark.createDataFrame(s_rows, SOURCE), SPEC)

    def days(found):
        total = Counter()
        for r in found:
            total[(r[0], r[1])] += (r[3] - r[2]).days
        return total

    assert days(expand_history(t, s, SPEC, "preserve", EVERY_TUNING[tuning]).collect()) \
        == days(t_rows)


def test_hot_key_with_copies_of_one_window(spark):
    """One key holds nearly everything, and most of it is one window."""
    day = dt.date(2020, 1, 1)
    t_rows = [(1, f"p{i % 3}", day, H, 1, None) for i in range(300)] + [
        (k, "q", day, H, 1, None) for k in range(2, 9)]
    s_rows = [(1, "X", day, H)] * 40 + [(1, "Y", day + dt.timedelta(i), H) for i in range(40)]
    t = target_history(spark.createDataFrame(t_rows, TARGET), SPEC)
    s = source_history(spark.createDataFrame(s_rows, SOURCE), SPEC)
    counts = {mode: expand_history(t, s, SPEC, mode, SPLIT_ALL).count() for mode in MODES}
    assert counts == dict.fromkeys(MODES, 300 * 80 + 7)


def test_thousand_windows_of_one_key(spark):
    first = dt.date(2000, 1, 1)
    step = [first + dt.timedelta(3 * i) for i in range(1001)]
    t_rows = [(1, "A", a, b, 0, None) for a, b in zip(step, step[1:])]
    s_rows = [(1, f"s{i}", a + dt.timedelta(1), b + dt.timedelta(1))
              for i, (a, b) in enumerate(zip(step, step[1:]))]
    t = target_history(spark.createDataFrame(t_rows, TARGET), SPEC)
    s = source_history(spark.createDataFrame(s_rows, SOURCE), SPEC)
    want = expand(t, s, "preserve")
    assert len(want) == 2000
    for tuning in ("split, all hot", "salted 5"):
        assert expand(t, s, "preserve", tuning) == want


def test_nested_columns_are_carried_by_every_strategy(spark):
    spec = HistorySpec(keys="id", passthrough="id,tags,eff_start_date,eff_end_date,active",
                       new_cols="props")
    t = target_history(spark.sql(
        "SELECT 1L AS id, map('a', 1) AS tags, date'2020-01-01' AS eff_start_date, "
        "date'3499-12-31' AS eff_end_date, 1 AS active, CAST(NULL AS array<string>) AS props"), spec)
    s = source_history(spark.sql(
        "SELECT 1L AS id, array('x', 'yy') AS props, date'2020-01-01' AS eff_start_date, "
        "date'2021-01-01' AS eff_end_date"), spec)
    assert measured_bytes(s) > measured_bytes(s.withColumn("_src_props", F.array()))
    for name, tuning in EVERY_TUNING.items():
        out = expand_history(t, s, spec, "preserve", tuning).orderBy("eff_start_date").collect()
        assert [(r.tags, r.props, r.active) for r in out] == [
            ({"a": 1}, ["x", "yy"], 0), ({"a": 1}, None, 1)], name


def test_bad_arguments(spark):
    t, s = target(spark, (1, "A", "2020-01-01", "H")), source(spark, (1, "X", "2020-01-01", "H"))
    with pytest.raises(ValueError):
        expand_history(t, s, SPEC, "outer")
    with pytest.raises(ValueError):
        overlap_rows(t, s, SPEC, "right")


@pytest.mark.parametrize("tuning", EVERY_TUNING)
def test_empty_windows_in_a_gap_keep_what_is_stored(spark, tuning):
    """A window without time in it meets no gap, whatever the way to join."""
    full = [(1, "a", d("2005-01-01"), d("2005-01-01"), 1, "OLD"), (1, "b", d("2006-01-01"), d("2005-01-01"), 1, "OLD"),
            (1, "c", d("2005-01-01"), d("2006-01-01"), 1, "OLD"), (1, "d", None, d("2006-01-01"), 1, "OLD")]
    t = target_history(spark.createDataFrame(full, TARGET), SPEC)
    s = source(spark, (1, "new", "2010-01-01", "2011-01-01"))
    found = {r[1]: r[2:] for r in rows(expand_history(t, s, SPEC, "preserve", EVERY_TUNING[tuning]))}
    assert found == {"a": ("2005-01-01", "2005-01-01", 1, "OLD"), "b": ("2006-01-01", "2005-01-01", 1, "OLD"),
                     "c": ("2005-01-01", "2006-01-01", 0, None), "d": (None, "2006-01-01", 1, "OLD")}


@pytest.mark.parametrize("tuning", ["plain", "split, all hot", "salted 5"])
def test_no_day_is_lost_beyond_the_year_9999(spark, tuning):
    t = target(spark, (1, "a", "2000-01-01", "9999-12-31")).withColumn(
        "eff_end_date", F.expr("date_add(eff_end_date, 400)"))
    s = source(spark, (1, "x", "2001-01-01", "2002-01-01"))
    days = F.sum(F.datediff("eff_end_date", "eff_start_date"))
    kept = expand_history(t, s, SPEC, "preserve", EVERY_TUNING[tuning])
    assert kept.agg(days).first() == t.agg(days).first() and kept.count() == 3


def test_absent_new_columns_are_added_and_types_are_the_targets(spark):
    raw = spark.createDataFrame([(1, "a", d("2000-01-01"), H, 1)], TARGET.rsplit(",", 1)[0])
    new = spark.createDataFrame([(1, "x", d("2001-01-01"), H)], SOURCE)
    t = target_history(raw, SPEC, new)
    assert t.schema["status"].dataType.simpleString() == "string"
    assert rows(expand_history(t, source_history(new, SPEC), SPEC, "inner")) == [(1, "a", "2001-01-01", "H", 1, "x")]
    with pytest.raises(ValueError):
        target_history(raw, SPEC)
    other = source_history(new.withColumn("status", F.lit(7)), SPEC)
    for mode in ("inner", "left", "preserve"):
        assert expand_history(t, other, SPEC, mode).schema["status"].dataType.simpleString() == "string"
