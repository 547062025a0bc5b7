"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. A temporary one is made only for a local session that names none."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        named = spark.conf.get("spark.checkpoint.dir", "")
        if not named and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="chronofold-"))
        folder = context.getCheckpointDir()
    return folder


def saved(df: DataFrame) -> DataFrame:
    """Write a table below the shared folder and read it back: the lineage ends there, and a lost executor loses none of it."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal digits, modulo the number of folds; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def fold_number(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds
