"""SCD-2 history analytics as plain Spark DataFrame jobs."""

from chronofold.spec import HistorySpec, JoinTuning

__all__ = ["HistorySpec", "JoinTuning"]
