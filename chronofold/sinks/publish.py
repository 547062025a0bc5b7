"""Publishing: validated, run-versioned Parquet output.

A run is written once to its own folder, checked there, and then published by adding one entry
to the run log; readers follow the newest entry. So a failed check leaves the old content in
place, a run never overwrites the files it reads, and going back is another log entry. One writer
per store is assumed.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions.columns import all_of, any_of, content_hash, differs
from chronofold.sinks.compaction import (
    GROUP, file_census, merged_rows, path_of, small_file_groups, with_file)
from chronofold.spec import HistorySpec

LOG_SCHEMA = ("run_id string, committed_at timestamp, commit_no long, operation string, "
              "summary map<string,string>")

#: Run and partition folders of a data file: the last folder named run is the store's, whatever folders lie above it.
_IN_RUN = "^.*/run/([^/]+)/(.*/)?[^/]*$"


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions present in ``df`` and keep all others."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def remove_path(spark: SparkSession, name: str) -> None:
    """Delete a file or a folder with all it holds; nothing happens if there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def colocated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of one key in few files of about the advisory size: small partitions are merged and
    a partition that a hot key inflates is split, both by measured size."""
    return df.hint("rebalance", *keys)


def clustered(df: DataFrame, sort_cols: Sequence[str], rows_per_file: int, rows: int) -> DataFrame:
    """Linear order by ``sort_cols`` (NULLs last) across files and inside each file.

    A hash of the whole row ends the range key, so many rows with equal sort columns can still be
    divided over several ranges.
    """
    order = [F.col(c).asc_nulls_last() for c in sort_cols]
    files = max(1, -(-rows // rows_per_file))
    return (df.repartitionByRange(files, *order, content_hash(df))
            .sortWithinPartitions(*order))


class RunStore:
    """Runs of one table under ``base``: data in ``run/<id>``, its schema in ``schema/<id>``, the log
    in ``runlog``. A compacted run also has a list, in ``kept/<id>``, of the files of earlier runs
    that are part of it."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self._log = f"{self.base}/runlog"

    def path(self, run_id: str) -> str:
        return f"{self.base}/run/{run_id}"

    def read(self, run_id: str) -> DataFrame:
        """A run with the columns, their order and types that it was staged with: partition values
        are text in the folder names, and would otherwise be guessed."""
        return reduce(DataFrame.unionByName, self._scans(run_id))

    def _scans(self, run_id: str, largest: int | None = None) -> list[DataFrame]:
        """The scans that make up a run, one per run folder; with ``largest`` of smaller files only.

        The names of kept files pass the driver, which lists the files of any table it reads.
        """
        text = self.spark.read.text(self._schema(run_id)).first()[0]
        schema = T.StructType.fromJson(json.loads(text))
        files = {self.path(run_id): [self.path(run_id)]} if self._exists(self.path(run_id)) else {}
        if self._exists(self._kept(run_id)):
            for row in self.spark.read.parquet(self._kept(run_id)).toLocalIterator():
                files.setdefault(self.path(row.run_id), []).append(row.file_path)
        scans = [self.spark.read.schema(schema).option("basePath", folder).parquet(*paths)
                 for folder, paths in files.items()]
        if largest is not None:
            scans = [scan.where(F.col("_metadata.file_size") < largest) for scan in scans]
        return [scan.select(*schema.names) for scan in scans]

    def _kept(self, run_id: str) -> str:
        return f"{self.base}/kept/{run_id}"

    def _schema(self, run_id: str) -> str:
        return f"{self.base}/schema/{run_id}"

    def stage(self, df: DataFrame, rows_per_file: int = 500_000,
              partition_by: Sequence[str] = ()) -> str:
        """Write a run that nobody reads yet."""
        return self._stage_as(uuid.uuid4().hex, df, rows_per_file, partition_by)

    def stage_observed(self, df: DataFrame, metrics: Mapping[str, Column],
                       rows_per_file: int = 500_000) -> tuple[str, dict]:
        """As ``stage``, and aggregates of the rows, taken while they are written.

        They are part of the stage that writes, whose tasks Spark counts once each: a task that is
        run again, or twice, adds nothing.
        """
        observation = Observation()
        run_id = self.stage(df.observe(observation, *[c.alias(n) for n, c in metrics.items()]),
                            rows_per_file)
        return run_id, observation.get

    def _stage_as(self, run_id: str, df: DataFrame, rows_per_file: int | None,
                  partition_by: Sequence[str]) -> str:
        writer = df.write
        if rows_per_file:
            writer = writer.option("maxRecordsPerFile", rows_per_file)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(run_id))
        (self.spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1)
         .write.text(self._schema(run_id)))
        return run_id

    def _hadoop_path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _hadoop_conf(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()

    def _exists(self, path: str) -> bool:
        hadoop = self._hadoop_path(path)
        return hadoop.getFileSystem(self._hadoop_conf()).exists(hadoop)

    def discard(self, run_id: str) -> None:
        """Delete the files of a run that is not published (any more)."""
        for name in (self.path(run_id), self._schema(run_id), self._kept(run_id)):
            self._remove(name)

    def _remove(self, name: str) -> None:
        remove_path(self.spark, name)

    def history(self) -> DataFrame:
        """One row per publish, roll-back, rewrite and expiry."""
        if not self._exists(self._log):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(self._log)

    def latest(self, n: int = 5) -> DataFrame:
        """The newest log entries, newest first."""
        return self.history().orderBy(F.desc("committed_at"), F.desc("commit_no")).limit(n)

    def _head(self):
        return self.history().where("operation <> 'expire'").orderBy(F.desc("commit_no")).first()

    def _commit(self, run_id: str, operation: str, summary: dict) -> None:
        last = self.history().agg(F.max("commit_no")).first()[0] or 0
        entries = [F.lit(str(x)) for pair in summary.items() for x in pair]
        (self.spark.range(1).select(
            F.lit(run_id).alias("run_id"),
            F.lit(dt.datetime.now(dt.timezone.utc)).alias("committed_at"),
            F.lit(last + 1).cast("long").alias("commit_no"),
            F.lit(operation).alias("operation"),
            (F.create_map(*entries) if entries
             else F.lit(None)).cast("map<string,string>").alias("summary"))
         .coalesce(1).write.mode("append").parquet(self._log))

    def publish(self, run_id: str, operation: str = "overwrite", **summary) -> None:
        """Make a staged run the current content."""
        if not self._exists(self.path(run_id)):
            raise ValueError(f"no such run: {run_id}")
        self._commit(run_id, operation, summary)

    def current(self) -> DataFrame:
        head = self._head()
        if head is None:
            raise ValueError("nothing has been published yet")
        return self.read(head.run_id)

    def rollback(self, run_id: str) -> None:
        """Make an earlier published run current again; no data is copied."""
        known = self.history().where((F.col("run_id") == run_id)
                                     & (F.col("operation") != "expire"))
        if known.isEmpty():
            raise ValueError(f"run was never published: {run_id}")
        self.publish(run_id, "rollback")

    def expirable(self, older_than: dt.datetime, retain_last: int = 2) -> DataFrame:
        """Published runs older than ``older_than``, never one of the newest ``retain_last`` runs
        nor the current one."""
        head = self._head()
        runs = (
            self.history().groupBy("run_id")
            .agg(F.max("commit_no").alias("commit_no"),
                 F.max("committed_at").alias("committed_at"),
                 F.max(F.col("operation") == "expire").alias("gone"))
            .where("not gone")
        )
        newest = runs.orderBy(F.desc("commit_no")).limit(retain_last)
        old = runs.join(newest, "run_id", "left_anti").where(
            (F.col("committed_at") < F.lit(older_than))
            & (F.col("run_id") != F.lit(head.run_id if head else None))
        ).select("run_id", "committed_at")
        # a run stays as long as a run that is not expired has files of it
        needed = self.history().where("summary['keeps'] IS NOT NULL").join(runs, "run_id", "left_semi")
        return old.join(needed.select(F.explode(F.split(F.col("summary")["keeps"], ",")).alias("run_id")),
                        "run_id", "left_anti")

    def expire(self, older_than: dt.datetime, retain_last: int = 2) -> list[str]:
        """Delete the files of expirable runs; the log keeps their entries."""
        gone = [row.run_id for row in self.expirable(older_than, retain_last).toLocalIterator()]
        for run_id in gone:
            self._commit(run_id, "expire", {})
            self.discard(run_id)
        return gone

    def rewrite_clustered(self, sort_cols: Sequence[str], rows_per_file: int = 500_000) -> str:
        """Publish the current content again, sorted and in files of even size."""
        table = self.current()
        rows = table.count()
        run_id = self.stage(clustered(table, sort_cols, rows_per_file, rows), rows_per_file)
        self.publish(run_id, "rewrite", rows=rows)
        return run_id

    def census(self) -> DataFrame:
        """file_path, file_size and row_count of the files of the current content."""
        return reduce(DataFrame.unionAll, map(file_census, self._scans(self._head().run_id)))

    def compact(self, min_bytes: int, target_bytes: int,
                sort_cols: Sequence[str] = ()) -> str | None:
        """Publish the current content with its small files merged, and all other files as they are.

        Files below ``min_bytes`` are merged into ones of about ``target_bytes``, partition by
        partition; only they are read. The new run holds the merged files and the list of the files
        it keeps of earlier runs. Returns the new run, or None if there is nothing to merge. Rows
        are counted before publishing.
        """
        head = self._head()
        if head is None:
            raise ValueError("nothing has been published yet")
        run_id = uuid.uuid4().hex
        census = self._work(run_id, "census", self.census())
        partition = F.regexp_extract("file_path", _IN_RUN, 2)
        grouped = small_file_groups(census, min_bytes, target_bytes, partition)
        numbers = grouped.select(GROUP).distinct().withColumn(
            "number", F.row_number().over(Window.orderBy(GROUP)) - 1)
        groups = self._work(run_id, "groups", grouped.join(numbers, GROUP).drop(GROUP))
        n_groups = groups.agg(F.count_distinct("number")).first()[0]
        if n_groups == 0:
            self._remove(f"{self.base}/work/{run_id}")
            return None

        small = reduce(DataFrame.unionByName, [
            with_file(scan) for scan in self._scans(head.run_id, min_bytes)])
        folder = census.select(partition.alias("folder")).first().folder
        self._stage_as(run_id, merged_rows(small, groups, n_groups, sort_cols), None,
                       [part.split("=")[0] for part in folder.split("/") if part])
        untouched = census.join(groups, "file_path", "left_anti")
        of_run = F.regexp_extract("file_path", _IN_RUN, 1)
        untouched.select(of_run.alias("run_id"), path_of("file_path").alias("file_path")).write.parquet(self._kept(run_id))

        wanted = census.join(groups, "file_path", "left_semi").agg(F.sum("row_count")).first()[0]
        written = self.spark.read.parquet(self.path(run_id)).count()
        if wanted != written:
            self.discard(run_id)
            raise RuntimeError(f"{written} rows were merged instead of {wanted}; nothing published")
        keeps = [r.run_id for r in self.spark.read.parquet(self._kept(run_id)).select("run_id")
                 .distinct().toLocalIterator()]
        rows = census.agg(F.sum("row_count")).first()[0]
        self.publish(run_id, "compact", rows=rows, merged_files=groups.count(), new_files=n_groups,
                     **({"keeps": ",".join(keeps)} if keeps else {}))
        self._remove(f"{self.base}/work/{run_id}")
        return run_id

    def _work(self, run_id: str, name: str, rows: DataFrame) -> DataFrame:
        path = f"{self.base}/work/{run_id}/{name}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def point_table(self, table: str) -> None:
        """Let a catalog table read the current run."""
        run_id = self._head().run_id
        if self._exists(self._kept(run_id)) and not self.spark.read.parquet(self._kept(run_id)).isEmpty():
            raise ValueError("a compacted run lies in several folders; rewrite it for a catalog table")
        location = self.path(run_id)
        if self.spark.catalog.tableExists(table):
            self.spark.sql("ALTER TABLE IDENTIFIER(:t) SET LOCATION '" + location + "'",
                           args={"t": table})
            self.spark.catalog.refreshTable(table)
        else:
            self.spark.catalog.createTable(table, path=location, source="parquet")


def overwrite_catalog_partitions(df: DataFrame, table: str) -> None:
    """Dynamic partition overwrite of a table in a v2 catalog that supports it."""
    df.writeTo(table).overwritePartitions()


def merge_into_catalog(staged: DataFrame, table: str, spec: HistorySpec) -> None:
    """Upsert and removal of stale parents as one MERGE, for a v2 catalog with row-level changes."""
    def pair(c):
        return F.col(f"{table}.{c}"), F.col(f"staged.{c}")

    incoming = staged.alias("staged")
    same = all_of(old == new for old, new in map(pair, (*spec.keys, spec.start)))
    changed = any_of(differs(old, new) for old, new in map(pair, (spec.end, *spec.new_cols)))
    updates = {c: F.col(f"staged.{c}") for c in (spec.end, spec.active, *spec.new_cols)}
    (incoming.mergeInto(table, same)
     .whenMatched(changed).update(updates)
     .whenNotMatched().insertAll()
     .whenNotMatchedBySource().delete()
     .merge())
