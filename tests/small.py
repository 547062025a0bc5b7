"""Hand-written histories M1-M14 of FIXTURES.md."""

import datetime as dt

from chronofold.sources.history import source_history, target_history
from chronofold.spec import HistorySpec, JoinTuning

H = dt.date(3499, 12, 31)
SPEC = HistorySpec(
    keys="id", passthrough="id,place,eff_start_date,eff_end_date,active", new_cols="status")
TARGET = "id long, place string, eff_start_date date, eff_end_date date, active int, status string"
SOURCE = "id long, status string, eff_start_date date, eff_end_date date"

SPLIT_ALL = JoinTuning("split", hot_pairs=-1, hot_rows=0, segment_rows=1, cell_rows=1)
DYADIC_ALL = JoinTuning("dyadic", hot_pairs=-1, hot_rows=0, segment_rows=1, cell_rows=1,
                        cell_pairs=1)
EVERY_TUNING = {
    "plain": JoinTuning("plain"),
    "split, nothing hot": JoinTuning(),
    "split, all hot": SPLIT_ALL,
    "dyadic, nothing hot": JoinTuning("dyadic"),
    "dyadic, all hot": DYADIC_ALL,
    "dyadic, few segments": JoinTuning("dyadic", hot_pairs=3, segment_rows=2, max_segments=3),
    "broadcast": JoinTuning("broadcast"),
    "broadcast refused": JoinTuning("broadcast", broadcast_bytes=0, hot_pairs=-1),
    "salted 1": JoinTuning("salted", salt_buckets=1),
    "salted 5": JoinTuning("salted", salt_buckets=5),
}


def d(text):
    return H if text == "H" else None if text is None else dt.date.fromisoformat(text)


def target(spark, *rows):
    """Rows (id, place, start, end[, status])."""
    full = [(r[0], r[1], d(r[2]), d(r[3]), int(d(r[3]) == H), r[4] if len(r) > 4 else None)
            for r in rows]
    return target_history(spark.createDataFrame(full, TARGET), SPEC)


def source(spark, *rows):
    """Rows (id, status, start, end)."""
    return source_history(
        spark.createDataFrame([(r[0], r[1], d(r[2]), d(r[3])) for r in rows], SOURCE), SPEC)


def rows(df):
    """(id, place, start, end, active, status), sorted, dates as text with H for the sentinel."""
    def text(x):
        return "H" if x == H else str(x) if isinstance(x, dt.date) else x

    found = [tuple(text(x) for x in r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((x is None, str(x)) for x in r))
