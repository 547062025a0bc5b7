"""Which files of a Parquet folder are worth merging, by their size in bytes.

The census comes from the files' own metadata: no data column is read. Files below a least size are put into groups of
about a target size, partition folder by partition folder; only they are read and written again. File names are
handled as tables, so their number is no concern of the driver beyond the listing that any scan needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Files that are put into groups together; bounds the window over them.
CHUNK = 4096
FILE, GROUP = "_file", "_group"


def with_file(table: DataFrame) -> DataFrame:
    """Each row with the name of the file that it comes from."""
    return table.withColumn(FILE, F.col("_metadata.file_path"))


def file_census(table: DataFrame) -> DataFrame:
    """file_path, file_size, row_count of the non-empty files that ``table`` (a scan) reads."""
    return (table.select("_metadata.file_path", "_metadata.file_size")
            .groupBy("file_path", "file_size").agg(F.count("*").alias("row_count")))


def small_file_groups(census: DataFrame, min_bytes: int, target_bytes: int,
                      folder: Column | None = None) -> DataFrame:
    """file_path, group of the files below ``min_bytes`` that can be merged with others.

    Files of a folder, largest first, fill groups of ``target_bytes``; all but the last differ from
    that by less than one small file. A folder with more than ``CHUNK`` small files is dealt into chunks by a
    hash of the names, and each chunk is grouped for itself. A file that would be alone in its
    group stays as it is. ``folder`` says which files belong together, if not those of one folder.
    """
    if not 0 < min_bytes <= target_bytes:
        raise ValueError("0 < min_bytes <= target_bytes is needed")
    folder = F.regexp_extract("file_path", "^(.*)/[^/]*$", 1) if folder is None else folder
    small = census.where(F.col("file_size") < min_bytes).withColumn("folder", folder)
    chunks = small.groupBy("folder").agg(F.ceil(F.count("*") / CHUNK).alias("_chunks"))
    dealt = small.join(chunks, "folder").withColumn(
        "_chunk", F.pmod(F.xxhash64("file_path"), F.col("_chunks")))
    largest_first = Window.partitionBy("folder", "_chunk").orderBy(F.desc("file_size"), "file_path")
    before = F.sum("file_size").over(largest_first) - F.col("file_size")
    placed = dealt.withColumn("_place", F.floor(before / target_bytes))
    together = Window.partitionBy("folder", "_chunk", "_place")
    grouped = placed.withColumn("_members", F.count("*").over(together)).where("_members > 1")
    return grouped.select("file_path", F.struct("folder", "_chunk", "_place").alias(GROUP))


def merged_rows(rows: DataFrame, groups: DataFrame, n_groups: int,
                sort_cols: Sequence[str] = ()) -> DataFrame:
    """The rows of the grouped files, each group in a task of its own.

    ``rows`` come from ``with_file``; ``groups`` has the columns file_path and number (from 0). Rows
    of a group are sorted by ``sort_cols``, NULLs last.
    """
    numbered = groups.select(F.col("file_path").alias(FILE), F.col("number").cast("int").alias(GROUP))
    dealt = rows.join(numbered, FILE).repartitionById(n_groups, F.col(GROUP)).drop(FILE, GROUP)
    order = [F.col(c).asc_nulls_last() for c in sort_cols]
    return dealt.sortWithinPartitions(*order) if order else dealt


def path_of(file_path: str) -> Column:
    """The path that a reader takes: the metadata give it as a URI, with escapes."""
    return F.url_decode(F.replace(F.col(file_path), F.lit("+"), F.lit("%2B")))
