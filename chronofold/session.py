"""Session helpers: a local session for tests and benchmarks, and the folder for work tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, name: str = "chronofold", **conf) -> SparkSession:
    """A small local session. A cluster brings its own session; nothing here is needed there."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """A fresh folder under the shared folder of ``spark.checkpoint.dir``.

    Only where a local session does not name one, as in tests, is a temporary folder used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = shared.rstrip("/") if shared else tempfile.mkdtemp(prefix="chronofold-")
    return f"{root}/chronofold-{uuid.uuid4().hex}"


def written(rows: DataFrame) -> DataFrame:
    """Through the shared folder: computed once, of known size when joined, and safe from lost executors."""
    path = work_folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


#: Rows that a task joins or sorts at once; what bounds its memory however large a table is.
ROWS_PER_TASK = 250_000


def dealt(rows: DataFrame, count: int, *keys: str) -> DataFrame:
    """Dealt by ``keys`` over as many tasks as ``count`` rows need, if the session has fewer."""
    tasks = -(-count // ROWS_PER_TASK)
    few = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *keys) if tasks > few else rows
