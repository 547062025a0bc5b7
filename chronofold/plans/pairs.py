"""Target and source histories derived from the star-schema tables, one pair per kind of job.

Every pair reads its tables in full. Some keys have no source history by nature (a market segment
without returns, users without large purchases), which the back-fill has to pass through.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.functions.columns import is_open
from chronofold.sources.history import (
    read_parquet, source_history, target_history, windows_from_events)
from chronofold.spec import HistorySpec


@dataclass(frozen=True)
class HistoryPair:
    spec: HistorySpec
    target_table: Callable[[SparkSession, str], DataFrame]
    source_table: Callable[[SparkSession, str], DataFrame]

    def target(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return target_history(self.target_table(spark, sf_dir), self.spec)

    def source(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return source_history(self.source_table(spark, sf_dir), self.spec)


def _as_target(history: DataFrame, spec: HistorySpec, types: dict[str, str]) -> DataFrame:
    """Add the flag and the columns that are still to be filled."""
    return history.select(
        "*", is_open(F.col(spec.end), spec.open_date).alias(spec.active),
        *[F.lit(None).cast(t).alias(c) for c, t in types.items()])


# Orders of a customer against the returned shipments of the same customer; single key.
F1 = HistorySpec(
    keys="id",
    passthrough="id,name,place,eff_start_date,eff_end_date,active",
    new_cols="salary,status",
)


def _f1_target(spark, sf_dir):
    orders, customer = (read_parquet(spark, sf_dir, t) for t in ("orders", "customer"))
    history = windows_from_events(
        orders.withColumnRenamed("o_custkey", "id"), ["id"], F.col("o_orderdate"),
        {"place": F.col("o_orderpriority")}, F1.start, F1.end, F1.open_date)
    named = history.join(customer.select(F.col("c_custkey").alias("id"),
                                         F.col("c_name").alias("name")), "id")
    return _as_target(named, F1, {"salary": "double", "status": "string"})


def _f1_source(spark, sf_dir):
    orders, lines = (read_parquet(spark, sf_dir, t) for t in ("orders", "lineitem"))
    returned = (lines.where("l_returnflag = 'R'")
                .join(orders, F.col("l_orderkey") == F.col("o_orderkey")))
    return windows_from_events(
        returned.withColumnRenamed("o_custkey", "ID"), ["ID"], F.col("l_shipdate"),
        {"Salary": F.col("l_extendedprice"), "Status": F.col("l_linestatus")},
        "Eff_Start_Date", "Eff_End_Date", F1.open_date)


# Views and clicks of a user against purchases; other names and sentinel, and a source with gaps:
# a purchase counts for at most six days.
F2 = HistorySpec(
    keys="customer_id",
    passthrough="customer_id,segment,valid_from,valid_to,is_current",
    new_cols="city",
    start="valid_from", end="valid_to", active="is_current", open_date="9999-12-31",
)


def _user_days(spark, sf_dir, wanted: Column, name: str, value: Column, last_end: str,
               max_days: int | None = None):
    events = read_parquet(spark, sf_dir, "events").where(wanted)
    return windows_from_events(
        events.withColumnRenamed("user_id", "customer_id"), ["customer_id"], F.col("ts"),
        {name: value}, F2.start, F2.end, last_end, max_days)


def _f2_target(spark, sf_dir):
    visits = _user_days(spark, sf_dir, F.col("event_type").isin("view", "click"),
                        "segment", F.col("event_type"), F2.open_date)
    return _as_target(visits, F2, {"city": "string"})


def _f2_source(spark, sf_dir):
    return _user_days(spark, sf_dir, F.col("event_type") == "purchase", "city", F.col("props"),
                      F2.open_date, max_days=6)


# Shipments of a supplier by return flag against the order days of finished orders' lines;
# composite key.
F3 = HistorySpec(
    keys="policy_id,product_code",
    passthrough="policy_id,product_code,coverage_type,eff_start_date,eff_end_date,active",
    new_cols="premium_amount",
)


def _f3_target(spark, sf_dir):
    shipped = windows_from_events(
        read_parquet(spark, sf_dir, "lineitem").withColumnsRenamed(
            {"l_suppkey": "policy_id", "l_returnflag": "product_code"}),
        F3.keys, F.col("l_shipdate"), {"coverage_type": F.col("l_linestatus")},
        F3.start, F3.end, F3.open_date)
    return _as_target(shipped, F3, {"premium_amount": "double"})


def _f3_source(spark, sf_dir):
    orders, lines = (read_parquet(spark, sf_dir, t) for t in ("orders", "lineitem"))
    ordered = (
        lines.join(orders.where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumnsRenamed({"l_suppkey": "policy_id", "l_returnflag": "product_code"}))
    return windows_from_events(
        ordered, F3.keys, F.col("o_orderdate"), {"premium_amount": F.col("l_extendedprice")},
        F3.src_start, F3.src_end, F3.open_date)


# Shipments of a part against finished orders of it; three new columns, date names that differ
# between the two sides, and a sentinel of its own.
F4 = HistorySpec(
    keys="employee_id",
    passthrough="employee_id,full_name,department,effective_from,effective_to,is_active",
    new_cols="grade,band,designation",
    start="effective_from", end="effective_to", src_start="grade_from", src_end="grade_to",
    active="is_active", open_date="2099-12-31",
)


def _f4_target(spark, sf_dir):
    lines, part = (read_parquet(spark, sf_dir, t) for t in ("lineitem", "part"))
    shipped = windows_from_events(
        lines.withColumnRenamed("l_partkey", "employee_id"), F4.keys, F.col("l_shipdate"),
        {"department": F.col("l_linestatus")}, F4.start, F4.end, F4.open_date)
    named = shipped.join(part.select(F.col("p_partkey").alias("employee_id"),
                                     F.col("p_name").alias("full_name")), "employee_id")
    return _as_target(named, F4, dict.fromkeys(F4.new_cols, "string"))


def _f4_source(spark, sf_dir):
    orders, lines = (read_parquet(spark, sf_dir, t) for t in ("orders", "lineitem"))
    finished = (
        lines.join(orders.where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumnRenamed("l_partkey", "employee_id"))
    return windows_from_events(
        finished, F4.keys, F.col("o_orderdate"),
        {"grade": F.col("o_orderpriority"), "band": F.col("o_orderstatus"),
         "designation": F.col("l_returnflag")},
        F4.src_start, F4.src_end, F4.open_date)


PAIRS = {
    "f1": HistoryPair(F1, _f1_target, _f1_source),
    "f2": HistoryPair(F2, _f2_target, _f2_source),
    "f3": HistoryPair(F3, _f3_target, _f3_source),
    "f4": HistoryPair(F4, _f4_target, _f4_source),
}

#: Which orders stand on the right: none that is NULL, NULL customers, NULL days, both apart, rows
#: of NULL in both columns, and none at all.
NOT_IN_CASES = {
    "complete": "o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT'",
    "null_first": "o_orderstatus = 'P'",
    "null_second": "o_orderstatus = 'O' AND o_orderpriority = '5-LOW' AND o_totalprice > 400000",
    "null_either": "o_totalprice > 400000 AND (o_orderstatus = 'O') <> (o_orderpriority = '1-URGENT')",
    "null_both": "o_orderpriority = '1-URGENT'",
    "nothing": "o_orderstatus = 'X'",
}
