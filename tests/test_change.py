"""Change classification and the merge form."""

from chronofold.operators import change
from chronofold.operators.overlap import overlap_rows
from small import SPEC, rows, source, target


def _case(spark):
    t = target(spark, (1, "Mumbai", "2018-11-19", "2023-02-13"),
               (2, "Pune", "2019-01-01", "H"), (3, "Goa", "2019-01-01", "H", "Z"),
               (4, "Agra", "2018-01-01", "2020-01-01"))
    s = source(spark, (1, "IS", "2018-11-19", "2021-09-28"), (1, "KS", "2021-09-28", "2023-03-13"),
               (3, "Z", "2010-01-01", "H"), (4, "Y", "2018-06-01", "2019-06-01"))
    return t, s, overlap_rows(t, s, SPEC, "left")


def test_classification(spark):
    t, _, staged = _case(spark)
    tags = {(r.id, str(r.eff_start_date)): r.cdc_action
            for r in change.classify_changes(staged, t, SPEC).collect()}
    assert tags == {(1, "2018-11-19"): "UPDATE", (1, "2021-09-28"): "INSERT",
                    (2, "2019-01-01"): "SAME", (3, "2019-01-01"): "SAME",
                    (4, "2018-06-01"): "INSERT"}
    counts = change.action_counts(change.classify_changes(staged, t, SPEC))
    assert {r.cdc_action: r.row_count for r in counts.collect()} == {
        "INSERT": 2, "UPDATE": 1, "SAME": 2}


def test_end_date_counts_only_if_compared(spark):
    t = target(spark, (1, "A", "2020-01-01", "H", "X"))
    s = source(spark, (1, "X", "2020-01-01", "2021-01-01"))
    staged = overlap_rows(t, s, SPEC)
    loose = change.classify_changes(staged, t, SPEC).first().cdc_action
    strict = change.classify_changes(staged, t, SPEC, ["eff_end_date", "status"]).first().cdc_action
    assert (loose, strict) == ("SAME", "UPDATE")


def test_merge_then_delete_equals_one_step(spark):
    t, _, staged = _case(spark)
    merged = change.merge_state(staged, t, SPEC)
    stale = change.stale_parents(merged, staged, SPEC)
    assert rows(stale) == [(4, "Agra", "2018-01-01", "2020-01-01", 0, None)]
    final = rows(change.without_stale_parents(merged, staged, SPEC))
    assert final == rows(change.backfilled_state(staged, t, SPEC)) == rows(staged)


def test_merge_keeps_stored_carried_columns_and_unchanged_flags(spark):
    t = target(spark, (1, "stored", "2020-01-01", "2021-01-01", "X")).replace(0, 7, ["active"])
    staged = target(spark, (1, "staged", "2020-01-01", "2021-01-01", "X"))
    assert rows(change.merge_state(staged, t, SPEC)) == [
        (1, "stored", "2020-01-01", "2021-01-01", 7, "X")]


def test_null_keys_are_equal_when_looking_for_stale_rows(spark):
    t = target(spark, (None, "A", "2020-01-01", "H"), (1, "B", "2020-01-01", "H"))
    staged = target(spark, (None, "A", "2020-01-01", "H"))
    assert [r.id for r in change.stale_parents(t, staged, SPEC).collect()] == [1]


def test_duplicate_starts(spark):
    t = target(spark, (1, "A", "2020-01-01", "H"), (1, "B", "2020-01-01", "H"),
               (2, "C", "2020-01-01", "H"))
    assert [(r.id, r.copies) for r in change.duplicate_starts(t, SPEC).collect()] == [(1, 2)]


def test_null_keys_are_no_repetition(spark):
    t = target(spark, (None, "a", "2000-01-01", "H"), (None, "b", "2000-01-01", "H"), (1, "c", None, "H"), (1, "d", None, "H"))
    assert change.duplicate_starts(t, SPEC).isEmpty()
