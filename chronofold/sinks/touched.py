"""Upsert into a partitioned folder that reads and writes only the partitions it changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.functions.columns import all_of, any_of
from chronofold.operators.change import duplicate_starts, merge_state
from chronofold.session import work_folder
from chronofold.sinks.compaction import path_of
from chronofold.sinks.publish import remove_path, write_partitions
from chronofold.spec import HistorySpec


def touched_partitions(stored: DataFrame, staged: DataFrame, spec: HistorySpec,
                       partition_by: Sequence[str], remove_stale: bool = False) -> DataFrame:
    """Distinct partition values that a merge may change.

    Those of stored rows that a staged row matches, or, to remove stale ones, of all rows of staged
    keys; and those that staged rows fall into. Reads keys, start and partition columns only.
    """
    matched_on = spec.keys if remove_stale else (*spec.keys, spec.start)
    incoming = staged.select(*matched_on).distinct()
    hit = stored.join(incoming, list(matched_on), "left_semi").select(*partition_by)
    return hit.unionAll(staged.select(*partition_by)).distinct()


def _in_partitions(values: Sequence, partition_by: Sequence[str]) -> Column:
    """A filter on partition columns that a scan can prune folders with."""
    return any_of([F.lit(False)] + [
        all_of(F.col(c).eqNullSafe(F.lit(row[c])) for c in partition_by) for row in values])


def _without_stale(stored: DataFrame, staged: DataFrame, spec: HistorySpec) -> DataFrame:
    """Stored rows but those whose key is staged and whose (key, start) is not."""
    starts = staged.select(*spec.keys, spec.start).distinct()
    known = starts.select(*spec.keys, F.lit(True).alias("_key_staged")).distinct()
    marked = stored.join(known, list(spec.keys), "left").join(
        starts.withColumn("_start_staged", F.lit(True)), [*spec.keys, spec.start], "left")
    return marked.where("_key_staged IS NULL OR _start_staged").select(*spec.target_cols)


def merge_touched(staged: DataFrame, path: str, spec: HistorySpec, partition_by: Sequence[str],
                  remove_stale: bool = False) -> DataFrame:
    """Lay staged rows over the folder ``path``, partitioned by ``partition_by``.

    The result is that of ``merge_state``; with ``remove_stale`` stored rows go whose key is staged
    but whose (key, start) is not. Partitions that no staged row concerns are neither read (but for
    keys, start and partition) nor written; their files stay as they are. Partitions that lose
    all their rows are removed. The list of changed partitions passes the driver, as the list of all
    partitions does when a folder is read. The new rows are written apart first, since Spark does not overwrite
    what it reads; a merge that fails before the last step leaves the folder as it was.

    Staged rows that repeat a key and start are refused. Returns the changed partitions.
    """
    spark, work = staged.sparkSession, work_folder(staged.sparkSession)
    staged.select(*spec.target_cols).write.parquet(f"{work}/staged")
    incoming = spark.read.schema(staged.select(*spec.target_cols).schema).parquet(f"{work}/staged")
    if not duplicate_starts(incoming, spec).isEmpty():
        remove_path(spark, work)
        raise ValueError("staged rows repeat a key and start date; the merge is ambiguous")

    stored = spark.read.schema(incoming.schema).parquet(path)
    touched = touched_partitions(stored, incoming, spec, partition_by, remove_stale).collect()
    kept = stored.where(_in_partitions(touched, partition_by)).select(*spec.target_cols)
    if remove_stale:
        kept = _without_stale(kept, incoming, spec)
    write_partitions(merge_state(incoming, kept, spec), f"{work}/merged", partition_by)

    merged = spark.read.schema(incoming.schema).parquet(f"{work}/merged").select(*spec.target_cols)
    left = {tuple(r) for r in merged.select(*partition_by).distinct().collect()}
    gone = [r for r in touched if tuple(r) not in left]
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1)
    emptied = (stored.where(_in_partitions(gone, partition_by)).select(folder.alias("folder")).distinct()
               .select(path_of("folder").alias("folder")).collect())
    write_partitions(merged, path, partition_by)
    for row in emptied:
        remove_path(spark, row.folder)
    remove_path(spark, work)
    schema = stored.select(*partition_by).schema
    return spark.createDataFrame([tuple(r) for r in touched], schema)
