"""Declarative description of one back-fill: which columns play which role, and how to join."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")

COVERAGE_MODES = ("inner", "left", "preserve")
STRATEGIES = ("split", "dyadic", "plain", "broadcast", "salted")


def _names(value) -> tuple[str, ...]:
    parts = value.split(",") if isinstance(value, str) else value
    return tuple(p.strip() for p in parts)


@dataclass(frozen=True)
class HistorySpec:
    """Columns of a target history and of the source history that enriches it.

    Lists may be given as sequences or as comma-separated text. ``passthrough`` is every target
    column except ``new_cols``, in output order; it includes the keys, both dates and the flag.
    """

    keys: tuple[str, ...]
    passthrough: tuple[str, ...]
    new_cols: tuple[str, ...]
    start: str = "eff_start_date"
    end: str = "eff_end_date"
    src_start: str | None = None
    src_end: str | None = None
    active: str = "active"
    open_date: str = "3499-12-31"

    def __post_init__(self):
        for field in ("keys", "passthrough", "new_cols"):
            object.__setattr__(self, field, _names(getattr(self, field)))
        object.__setattr__(self, "src_start", self.src_start or self.start)
        object.__setattr__(self, "src_end", self.src_end or self.end)

        named = self.target_cols + self.keys + (
            self.start, self.end, self.src_start, self.src_end, self.active)
        bad = [c for c in named if not _IDENTIFIER.fullmatch(c)]
        if bad:
            raise ValueError(f"not a plain column name: {bad}")
        if any(c.startswith("_") for c in self.target_cols):
            raise ValueError("column names that start with an underscore are reserved")
        if not self.keys or not self.new_cols:
            raise ValueError("at least one key and one new column are needed")
        if len(set(self.target_cols)) != len(self.target_cols):
            raise ValueError("a column is listed twice in passthrough and new_cols")
        missing = {*self.keys, self.start, self.end, self.active} - set(self.passthrough)
        if missing:
            raise ValueError(f"passthrough must also list {sorted(missing)}")
        dt.date.fromisoformat(self.open_date)

    @property
    def target_cols(self) -> tuple[str, ...]:
        return self.passthrough + self.new_cols

    @property
    def carried(self) -> tuple[str, ...]:
        """Target columns copied unchanged to every piece of a split row (without the keys)."""
        roles = {*self.keys, self.start, self.end, self.active}
        return tuple(c for c in self.passthrough if c not in roles)

    @property
    def source_cols(self) -> tuple[str, ...]:
        return self.keys + self.new_cols + (self.src_start, self.src_end)


@dataclass(frozen=True)
class JoinTuning:
    """How the overlap join is distributed. None of these values changes the result.

    split      plain join for ordinary keys; a key whose candidate pairs exceed ``hot_pairs`` or
               whose rows exceed ``hot_rows`` is cut into time segments and salted (default)
    dyadic     as split, but a window is put on the few nodes of a tree that make it up instead of
               on every segment that it touches, cells are divided by their counted rows and pairs,
               and any number of keys may be hot (``max_hot_keys`` does not apply)
    plain      one equi + range join, left to Catalyst and AQE
    broadcast  the source is broadcast if what would be sent, measured, is within
               ``broadcast_bytes``; otherwise the split form is used
    salted     every key is spread over ``salt_buckets`` buckets
    """

    strategy: str = "split"
    hot_pairs: int = 200_000_000
    hot_rows: int = 5_000_000
    max_hot_keys: int = 10_000
    segment_rows: int = 256
    max_segments: int = 4_096
    cell_rows: int = 1_000_000
    cell_pairs: int = 100_000_000
    salt_buckets: int = 50
    broadcast_bytes: int = 256 * 1024 * 1024

    def __post_init__(self):
        if self.strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")
        counts = (self.max_hot_keys, self.segment_rows, self.max_segments, self.cell_rows,
                  self.cell_pairs, self.salt_buckets)
        if min(counts) < 1:
            raise ValueError("tuning counts must be at least 1")
