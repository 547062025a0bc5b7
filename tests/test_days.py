"""Days that a key covers before and after a back-fill."""

import datetime as dt
import random

import pytest

from chronofold.operators.checks import covered_days, lost_days
from chronofold.plans.jobs import LOST_DAYS, ValidationFailed, run_overwrite
from chronofold.sinks.publish import RunStore
from small import SPEC, source, target


def by_hand(rows):
    days = {}
    for key, _, a, b in rows:
        held = days.setdefault(key, set())
        if a and b:
            first, last = dt.date.fromisoformat(a), dt.date.fromisoformat(b)
            held |= {first + dt.timedelta(n) for n in range((last - first).days)}
    return days


def test_days_against_sets_of_days(spark):
    rng = random.Random(8)

    def some(n):
        out = [(rng.choice([1, 2, 3, None]), "x", f"2020-0{rng.randrange(1, 6)}-{rng.randrange(10, 28)}",
                f"2020-0{rng.randrange(1, 8)}-{rng.randrange(10, 28)}") for _ in range(n)]
        return out + [(1, "x", None, "2020-02-01"), (1, "x", "2020-02-01", None), (4, "x", "2020-02-02", "2020-02-02")]

    before, after = some(25) + [(7, "x", "2020-01-01", "2020-01-05")], some(12) + [(8, "x", "2020-01-01", "2020-01-05")]
    b, a = by_hand(before), by_hand(after)
    want = {k: (len(b.get(k, ())), len(a.get(k, ())), len(b.get(k, set()) - a.get(k, set())))
            for k in b | a if b.get(k) or a.get(k)}
    found = covered_days(target(spark, *before), target(spark, *after), SPEC)
    assert {r.id: (r.days_before, r.days_after, r.days_lost) for r in found.collect()} == want
    lost = lost_days(target(spark, *before), target(spark, *after), SPEC).collect()
    assert {r.id for r in lost} == {k for k, v in want.items() if v[2]} >= {7}


def test_an_inner_run_that_loses_days_is_refused(spark, tmp_path):
    t = target(spark, (1, "a", "2020-01-01", "H"))
    s = source(spark, (1, "X", "2020-02-01", "H"))
    store = RunStore(spark, str(tmp_path))
    with pytest.raises(ValidationFailed, match="lost_days: 31 of 1 keys"):
        run_overwrite(t, s, SPEC, store, "inner")
    assert store.history().isEmpty()
    assert run_overwrite(t, s, SPEC, store, "inner", ignore=[LOST_DAYS]).output_rows == 1
    assert run_overwrite(t, s, SPEC, store, "preserve").output_rows == 2
