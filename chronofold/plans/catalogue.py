"""Registered queries: every operator over the whole tables of a data directory."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.functions.columns import divisible_only_by, sphere_volume, swapped_name
from chronofold.operators import change, checks, coverage, summaries
from chronofold.operators.membership import not_in
from chronofold.operators.overlap import expand_history, overlap_pairs, overlap_rows
from chronofold.plans.jobs import LOST_DAYS, ValidationFailed, run_merge, run_overwrite
from chronofold.plans.pairs import NOT_IN_CASES, PAIRS
from chronofold.plans.sql_form import (backfill_sql, insert_overwrite_sql, merge_sql,
                                       run_overwrite_script)
from chronofold.session import work_folder, written
from chronofold.sinks.publish import RunStore, colocated, write_partitions
from chronofold.sinks.touched import merge_touched
from chronofold.sources.history import read_parquet
from chronofold.spec import HistorySpec, JoinTuning

Query = Callable[[SparkSession, str], DataFrame]

# Low limits, so that many keys of the test tables take the hot-key way.
EVERY_KEY_HOT = JoinTuning("split", hot_pairs=20, hot_rows=20, segment_rows=2, cell_rows=4)

EVERY_KEY_DYADIC = JoinTuning("dyadic", hot_pairs=20, hot_rows=20, segment_rows=2, cell_rows=4,
                              cell_pairs=8)


def _load(pair: str, spark: SparkSession, sf_dir: str):
    """Both histories of a pair as tables: they are derived from events once, however often they are read."""
    p = PAIRS[pair]
    return written(p.target(spark, sf_dir)), written(p.source(spark, sf_dir)), p.spec


def _on(pair: str, operator) -> Query:
    """A query that applies ``operator(target, source, spec)`` to a pair."""
    return lambda spark, sf_dir: operator(*_load(pair, spark, sf_dir))


def _once(pair: str, operator) -> Query:
    """As ``_on``, for operators that read each history once at most, as it is derived."""
    p = PAIRS[pair]
    return lambda spark, sf_dir: operator(p.target(spark, sf_dir), p.source(spark, sf_dir), p.spec)


def _expanded(coverage_mode: str, **tuning):
    return partial(expand_history, coverage=coverage_mode, tuning=JoinTuning(**tuning))


def _left(target, source, spec):
    return overlap_rows(target, source, spec, "left")


def _inner_state(target, source, spec):
    return expand_history(target, source, spec, "inner")


def _merged(target, source, spec):
    """The table after the upsert, with the parents that a later step removes."""
    return change.merge_state(_left(target, source, spec), target, spec)


def _classified(target, source, spec, with_end=False):
    compare = ((spec.end,) if with_end else ()) + spec.new_cols
    return change.classify_changes(_left(target, source, spec), target, spec, compare)


def _first_key(spec: HistorySpec) -> HistorySpec:
    return replace(spec, keys=spec.keys[:1])


def _repeated_starts(target, source, spec):
    """Starts that are unique per full key repeat when only the first key column is looked at."""
    return change.duplicate_starts(target, _first_key(spec))


def _sql_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source, spec = PAIRS["f1"], PAIRS["f1"], PAIRS["f1"].spec
    return backfill_sql(spark, target.target(spark, sf_dir), source.source_table(spark, sf_dir),
                        spec)


def _sql_merge(target, source, spec, stale=True):
    return merge_sql(_left(target, source, spec), target, spec, stale)


def _sql_insert(spark: SparkSession, sf_dir: str, insert=insert_overwrite_sql) -> DataFrame:
    """Write target and source as tables, then INSERT OVERWRITE a third one from them."""
    pair, folder = PAIRS["f3"], work_folder(spark)
    names = {role: f"chronofold_{role}_{uuid.uuid4().hex}" for role in ("tgt", "src", "out")}
    pair.target(spark, sf_dir).write.parquet(f"{folder}/tgt")
    pair.source_table(spark, sf_dir).write.parquet(f"{folder}/src")
    spark.read.parquet(f"{folder}/tgt").limit(0).write.parquet(f"{folder}/out")
    try:
        for role, name in names.items():
            spark.catalog.createTable(name, path=f"{folder}/{role}", source="parquet")
        insert(spark, names["out"], names["tgt"], names["src"], pair.spec)
    finally:
        for name in names.values():
            spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})
    return spark.read.parquet(f"{folder}/out")


def _store(spark: SparkSession) -> RunStore:
    return RunStore(spark, work_folder(spark))


def _readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    store.publish(store.stage(_inner_state(*_load("f1", spark, sf_dir))))
    return store.current()


def _rolled_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the inner form, then the left form, then return to the first."""
    target, source, spec = _load("f1", spark, sf_dir)
    store = _store(spark)
    first = store.stage(_inner_state(target, source, spec))
    store.publish(first)
    store.publish(store.stage(_left(target, source, spec)))
    store.rollback(first)
    return store.current()


def _rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source, spec = _load("f1", spark, sf_dir)
    store = _store(spark)
    store.publish(store.stage(_inner_state(target, source, spec)))
    store.rewrite_clustered([*spec.keys, spec.start])
    return store.current()


def _colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published with the rows of a key in few files of even size."""
    target, source, spec = _load("f1", spark, sf_dir)
    store = _store(spark)
    store.publish(store.stage(colocated(_inner_state(target, source, spec), spec.keys)))
    return store.current()


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published in many files, whose small ones are then merged."""
    target, source, spec = _load("f1", spark, sf_dir)
    store = _store(spark)
    rows = _inner_state(target, source, spec).repartition(16, *spec.keys)
    store.publish(store.stage(rows, rows_per_file=2_000, partition_by=[spec.active]))
    sizes = store.census().agg(F.percentile_approx("file_size", 0.8).alias("most"))
    most = sizes.first().most
    store.compact(most, 4 * most, [*spec.keys, spec.start])
    return store.current()


def _run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after two publishes, a roll-back, a rewrite and an expiry, newest five first."""
    target, source, spec = _load("f1", spark, sf_dir)
    store = _store(spark)
    first = store.stage(_inner_state(target, source, spec))
    store.publish(first, rows=store.read(first).count())
    second = store.stage(_left(target, source, spec))
    store.publish(second, "merge", rows=store.read(second).count())
    store.rollback(first)
    store.rewrite_clustered([*spec.keys, spec.start])
    store.expire(dt.datetime.now(dt.timezone.utc), retain_last=2)
    return store.latest(5).select(
        "commit_no", "operation", F.col("summary")["rows"].cast("long").alias("rows"))


def _partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the current-row partition is replaced; the history partition stays as it was."""
    target, source, spec = _load("f1", spark, sf_dir)
    path = work_folder(spark)
    write_partitions(target, path, [spec.active])
    write_partitions(_inner_state(target, source, spec).where(F.col(spec.active) == 1), path,
                     [spec.active])
    return spark.read.parquet(path).select(*spec.target_cols)


def _merge_touched(partition: str, remove_stale: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expansion of urgent and high orders laid over a folder that holds the orders of all kinds."""
    target, source, spec = _load("f1", spark, sf_dir)
    path = work_folder(spark)
    write_partitions(target, path, [partition])
    feed = _left(target.where("place IN ('1-URGENT', '2-HIGH')"), source, spec)
    merge_touched(feed, path, spec, [partition], remove_stale)
    return spark.read.schema(target.schema).parquet(path).select(*spec.target_cols)


def _whole_job(spark: SparkSession, sf_dir: str, f: str, run: Callable, *args) -> DataFrame:
    """A whole job (stage, check, publish) and the content that readers then see.

    The ``check_*`` queries show what the checks find in these data; here they do not stop it.
    """
    store = _store(spark)
    run(*_load(f, spark, sf_dir), store, *args, ignore=(*checks.CHECKS, LOST_DAYS))
    return store.current()


def _refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job whose run does not pass its checks leaves the content that was published before."""
    target, source, spec = _load("f1", spark, sf_dir)
    store = _store(spark)
    store.publish(store.stage(target))
    try:
        run_overwrite(target.unionByName(target), source, spec, store, "inner")
    except ValidationFailed:
        return store.current()
    raise AssertionError("a run with overlapping windows was published")


def _with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by (customer, day): no customer on urgent ones, no day where the status is open."""
    return read_parquet(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
        "if(o_orderpriority = '1-URGENT', NULL, o_custkey) AS cust",
        "if(o_orderstatus = 'O', NULL, CAST(o_orderdate AS DATE)) AS day")


def _not_in(others: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose (customer, day) is NOT IN those of the orders that ``others`` selects."""
    rows = _with_nulls(spark, sf_dir)
    return not_in(rows, ("cust", "day"), rows.where(others), ("cust", "day"))


def _not_in_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns: lines that agree with no cheap returned line."""
    lines = read_parquet(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice",
        "nullif(l_suppkey, 1) AS supp", "nullif(l_linestatus, 'O') AS status",
        "nullif(CAST(l_quantity AS INT), 7) AS quantity")
    return not_in(lines, ("supp", "status", "quantity"), lines.where("l_returnflag = 'R' AND l_extendedprice < 20000"),
                  ("supp", "status", "quantity"))


def _modular_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per block of 1,201 consecutive order keys: those divisible by 7 and not by 5, as one list.

    Copies of a key are combined first, so a list never exceeds the numbers of its block.
    """
    key = F.col("o_orderkey")
    return (
        read_parquet(spark, sf_dir, "orders")
        .where(divisible_only_by(key, 7, 5))
        .select(F.expr("o_orderkey div 1201").alias("block"), key).distinct()
        .groupBy("block")
        .agg(F.expr("listagg(CAST(o_orderkey AS STRING), ',') WITHIN GROUP (ORDER BY o_orderkey)")
             .alias("numbers"))
    )


def _reversed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, sf_dir, "customer").select(
        "c_custkey", F.reverse("c_name").alias("reversed_name"))


def _swapped_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = (F.split_part("p_name", F.lit(" "), F.lit(n)) for n in (1, 2))
    return read_parquet(spark, sf_dir, "part").select(
        "p_partkey", swapped_name(first, last).alias("swapped_name"),
        swapped_name(F.reverse(last), F.reverse(first)).alias("letters_reversed"))


def _sphere_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, sf_dir, "part").select(
        "p_partkey", sphere_volume(F.col("p_size").cast("double")).alias("volume"))


def all_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}

    q["target_scan_f1"] = _once("f1", lambda t, s, spec: t)
    q["source_scan_f1"] = _once("f1", lambda t, s, spec: s)
    q["overlap_pairs_f1"] = _on("f1", overlap_pairs)
    for f in PAIRS:
        q[f"overlap_inner_{f}"] = _on(f, overlap_rows)
        q[f"overlap_left_{f}"] = _on(f, _left)
        q[f"backfill_inner_{f}"] = _on(f, _inner_state)
        q[f"backfill_preserve_{f}"] = _on(f, expand_history)
    q["covered_rows_f1"] = _once("f1", lambda t, s, spec: coverage.covered_rows(t, s, spec.keys))
    q["passthrough_rows_f1"] = _once(
        "f1", lambda t, s, spec: coverage.uncovered_rows(t, s, spec.keys))
    q["source_gaps_f2"] = _once("f2", lambda t, s, spec: coverage.source_gaps(s, spec.keys))

    q["backfill_sql_f1"] = _sql_form
    q["insert_overwrite_f3"] = _sql_insert
    q["overwrite_script_f3"] = partial(_sql_insert, insert=run_overwrite_script)
    for strategy in ("plain", "broadcast", "salted"):
        q[f"backfill_{strategy}_f1"] = _on("f1", _expanded("inner", strategy=strategy))
    q["backfill_salted_preserve_f3"] = _on("f3", _expanded("preserve", strategy="salted",
                                                           salt_buckets=5))
    for f in ("f1", "f3"):
        q[f"hot_keys_inner_{f}"] = _on(
            f, partial(expand_history, coverage="inner", tuning=EVERY_KEY_HOT))
        q[f"hot_keys_left_{f}"] = _on(
            f, partial(expand_history, coverage="left", tuning=EVERY_KEY_HOT))
        q[f"hot_keys_preserve_{f}"] = _on(
            f, partial(expand_history, coverage="preserve", tuning=EVERY_KEY_HOT))

    for f in PAIRS:
        q[f"overlap_dyadic_{f}"] = _on(f, partial(overlap_rows, tuning=EVERY_KEY_DYADIC))
    for f, mode in (("f1", "inner"), ("f3", "left"), ("f2", "preserve"), ("f3", "preserve")):
        q[f"dyadic_{mode}_{f}"] = _on(
            f, partial(expand_history, coverage=mode, tuning=EVERY_KEY_DYADIC))

    q["cdc_classify_f1"] = _on("f1", _classified)
    q["cdc_classify_strict_f1"] = _on("f1", partial(_classified, with_end=True))
    q["cdc_counts_f1"] = _on("f1", lambda *a: change.action_counts(_classified(*a)))
    q["merge_state_f1"] = _on("f1", _merged)
    q["merge_sql_f1"] = _on("f1", _sql_merge)
    q["merge_sql_backfill_f1"] = _on("f1", partial(_sql_merge, stale=False))
    q["stale_parents_f1"] = _on(
        "f1", lambda t, s, spec: change.stale_parents(t, _left(t, s, spec), spec))
    q["delete_stale_f1"] = _on("f1", lambda t, s, spec: change.without_stale_parents(
        _merged(t, s, spec), _left(t, s, spec), spec))
    q["merge_backfill_f1"] = _on(
        "f1", lambda t, s, spec: change.backfilled_state(_left(t, s, spec), t, spec))
    q["duplicate_starts_f3"] = _once("f3", _repeated_starts)

    for f in ("f1", "f2", "f4"):
        q[f"check_gaps_{f}"] = _on(
            f, lambda t, s, spec: checks.date_gaps(_inner_state(t, s, spec), spec))
    q["check_gaps_merge_f1"] = _on(
        "f1", lambda t, s, spec: checks.date_gaps(_merged(t, s, spec), spec))
    q["check_overlaps_f1"] = _on(
        "f1", lambda t, s, spec: checks.date_overlaps(_merged(t, s, spec), spec))
    q["check_overlaps_strict_f1"] = _on(
        "f1", lambda t, s, spec: checks.date_overlaps(_merged(t, s, spec), spec, strict=True))
    q["check_nulls_f2"] = _on(
        "f2", lambda t, s, spec: checks.unexpected_nulls(_left(t, s, spec), s, spec))
    q["check_active_multi_f1"] = _on(
        "f1", lambda t, s, spec: checks.active_flag_findings(_merged(t, s, spec), spec, False))
    q["check_active_multi_f3"] = _once(
        "f3", lambda t, s, spec: checks.active_flag_findings(t, _first_key(spec), False))
    q["check_active_exact_f2"] = _on(
        "f2", lambda t, s, spec: checks.active_flag_findings(_inner_state(t, s, spec), spec, True))
    for f in PAIRS:
        q[f"check_rowcount_{f}"] = _on(
            f, lambda t, s, spec: checks.row_count_check(t, _inner_state(t, s, spec)))
        q[f"check_days_{f}"] = _on(
            f, lambda t, s, spec: checks.covered_days(t, _inner_state(t, s, spec), spec))
        q[f"check_verdict_{f}"] = _on(
            f, lambda t, s, spec: checks.verdict(t, _inner_state(t, s, spec), s, spec))
    q["check_lost_days_f2"] = _on(
        "f2", lambda t, s, spec: checks.lost_days(t, _inner_state(t, s, spec), spec))
    q["check_lost_days_preserve_f2"] = _on(
        "f2", lambda t, s, spec: checks.lost_days(t, expand_history(t, s, spec), spec))
    q["check_verdict_merge_f1"] = _on(
        "f1", lambda t, s, spec: checks.verdict(t, _merged(t, s, spec), s, spec, True))

    q["preflight_counts_f1"] = _once("f1", summaries.preflight_counts)
    q["preflight_counts_f3"] = _once("f3", summaries.preflight_counts)
    q["population_summary_f1"] = _on("f1", lambda t, s, spec: summaries.population_summary(
        _inner_state(t, s, spec), spec, "salary"))
    q["key_summary_f1"] = _on(
        "f1", lambda t, s, spec: summaries.key_summary(_inner_state(t, s, spec), spec))
    q["expansion_ratio_f1"] = _on(
        "f1", lambda t, s, spec: summaries.expansion_ratio(t, _inner_state(t, s, spec)))
    q["final_listing_f1"] = _on(
        "f1", lambda t, s, spec: summaries.listing(_inner_state(t, s, spec), spec))

    q["publish_readback_f1"] = _readback
    q["publish_rollback_f1"] = _rolled_back
    q["clustered_rewrite_f1"] = _rewritten
    q["colocated_rewrite_f1"] = _colocated
    q["compacted_files_f1"] = _compacted
    q["partition_overwrite_f1"] = _partition_overwrite
    q["run_history_f1"] = _run_history
    q["merge_touched_f1"] = partial(_merge_touched, "place", False)
    q["merge_touched_moving_f1"] = partial(_merge_touched, "active", False)
    q["merge_touched_stale_f1"] = partial(_merge_touched, "place", True)

    q["job_overwrite_inner_f1"] = lambda spark, sf_dir: _whole_job(
        spark, sf_dir, "f1", run_overwrite, "inner")
    q["job_overwrite_preserve_f3"] = lambda spark, sf_dir: _whole_job(
        spark, sf_dir, "f3", run_overwrite, "preserve")
    q["job_merge_f1"] = lambda spark, sf_dir: _whole_job(
        spark, sf_dir, "f1", run_merge)
    q["job_refused_f1"] = _refused

    for name, others in NOT_IN_CASES.items():
        q[f"not_in_null_aware_{name}"] = partial(_not_in, others)
    q["not_in_null_aware_three"] = _not_in_three
    q["stale_parents_null_aware_f1"] = _on("f1", lambda t, s, spec: change.stale_parents(
        t, _left(t, s, spec), spec, null_aware=True))

    q["modular_filter_list"] = _modular_list
    q["reverse_text"] = _reversed_text
    q["swap_name"] = _swapped_names
    q["cubic_measure"] = _sphere_volumes
    return q
