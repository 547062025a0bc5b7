"""The back-fills as Spark SQL for any table pair: overwrite and merge as single statements, and the overwrite as a script."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from chronofold.spec import HistorySpec


def _list(*names: str) -> str:
    return ", ".join(names)


def backfill_statement(spec: HistorySpec, target: str = "{target}",
                       source: str = "{source}") -> str:
    """SQL text with ``:open_date`` as parameter.

    ``target`` and ``source`` are table names, or by default slots for DataFrames. Every other name
    comes from the spec, which admits plain identifiers only.
    """
    keys_equal = " AND ".join(f"t.{k} = s.src_{k}" for k in spec.keys)
    known_key = " AND ".join(f"t.{k} = c.src_{k}" for k in spec.keys)
    computed = {
        spec.start: f"greatest(t.{spec.start}, s.src_from)",
        spec.end: f"least(t.{spec.end}, s.src_to)",
        spec.active: f"CASE WHEN least(t.{spec.end}, s.src_to) = CAST(:open_date AS DATE) "
                     "THEN 1 ELSE 0 END",
        **{c: f"s.src_{c}" for c in spec.new_cols},
    }
    expanded = _list(*[f"{computed.get(c, f't.{c}')} AS {c}" for c in spec.target_cols])
    dates = (spec.start, spec.end)
    return f"""
WITH tgt AS (
  SELECT {_list(*[f"CAST({c} AS DATE) AS {c}" if c in dates else c for c in spec.target_cols])}
  FROM {target}
), src AS (
  SELECT {_list(*[f"{c} AS src_{c}" for c in spec.keys + spec.new_cols])},
         CAST({spec.src_start} AS DATE) AS src_from, CAST({spec.src_end} AS DATE) AS src_to
  FROM {source}
), src_keys AS (
  SELECT DISTINCT {_list(*[f"src_{k}" for k in spec.keys])} FROM src
)
SELECT {expanded}
FROM tgt t JOIN src s ON {keys_equal}
 AND s.src_from < t.{spec.end} AND s.src_to > t.{spec.start}
UNION ALL
SELECT {_list(*[f"t.{c}" for c in spec.target_cols])}
FROM tgt t LEFT ANTI JOIN src_keys c ON {known_key}
"""


def backfill_sql(spark: SparkSession, target: DataFrame, source: DataFrame,
                 spec: HistorySpec) -> DataFrame:
    return spark.sql(backfill_statement(spec), args={"open_date": spec.open_date},
                     target=target, source=source)


def insert_overwrite_sql(spark: SparkSession, into: str, target: str, source: str,
                         spec: HistorySpec) -> None:
    """INSERT OVERWRITE of table ``into``, which must not be one of the tables read."""
    if into in (target, source):
        raise ValueError("a statement cannot overwrite the table it reads; use a staging table")
    text = backfill_statement(spec, "IDENTIFIER(:target)", "IDENTIFIER(:source)")
    spark.sql(f"INSERT OVERWRITE TABLE IDENTIFIER(:into) {text}", args={
        "into": into, "target": target, "source": source, "open_date": spec.open_date})


@contextmanager
def staged_view(staged: DataFrame) -> Iterator[str]:
    """A temporary view of the staged rows under a name of its own, for SQL statements to read."""
    name = f"chronofold_staged_{uuid.uuid4().hex}"
    staged.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        staged.sparkSession.catalog.dropTempView(name)


def merge_statement(spec: HistorySpec, staged: str, target: str = "{target}",
                    stale: bool = True) -> str:
    """SQL text of the table after the upsert of ``staged``: a full join on key and start.

    A stored row that meets a staged one takes its end, flag and new columns if the end or a new
    column differs, NULLs included. Without ``stale``, stored rows that meet none are left out.
    """
    row_id = (*spec.keys, spec.start)
    same = " AND ".join(f"n.{c} = o.{c}" for c in row_id)
    differs = " OR ".join(f"n.{c} IS DISTINCT FROM o.{c}" for c in (spec.end, *spec.new_cols))
    updated = (spec.end, spec.active, *spec.new_cols)

    def value(c: str) -> str:
        if c in updated:
            return (f"CASE WHEN n.is_staged AND (o.is_stored IS NULL OR {differs}) "
                    f"THEN n.{c} ELSE o.{c} END AS {c}")
        return f"CASE WHEN o.is_stored THEN o.{c} ELSE n.{c} END AS {c}"

    columns = _list(*spec.target_cols)
    return f"""
WITH incoming AS (SELECT {columns}, TRUE AS is_staged FROM {staged}),
stored AS (SELECT {columns}, TRUE AS is_stored FROM {target})
SELECT {", ".join(value(c) for c in spec.target_cols)}
FROM incoming n {"FULL" if stale else "LEFT"} JOIN stored o ON {same}
"""


def merge_sql(staged: DataFrame, target: DataFrame, spec: HistorySpec,
              stale: bool = True) -> DataFrame:
    """``merge_state``, or without ``stale`` ``backfilled_state``, as one statement over a view."""
    with staged_view(staged) as name:
        return staged.sparkSession.sql(merge_statement(spec, name, stale=stale), target=target)


def _literal(text: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.\-]+", text):
        raise ValueError(f"not a plain table name or date: {text!r}")
    return f"'{text}'"


def overwrite_script(into: str, target: str, source: str, spec: HistorySpec) -> str:
    """A SQL script whose first lines are its parameters: the three tables and the open date.

    It ends without writing where the source has no rows. Tables and date are plain text, so the
    script can be kept in a file and its parameters edited there.
    """
    if into in (target, source):
        raise ValueError("a statement cannot overwrite the table it reads; use a staging table")
    dt.date.fromisoformat(spec.open_date)
    body = backfill_statement(spec, "IDENTIFIER(target_table)", "IDENTIFIER(source_table)")
    return f"""BEGIN
  DECLARE target_table STRING DEFAULT {_literal(target)};
  DECLARE source_table STRING DEFAULT {_literal(source)};
  DECLARE into_table STRING DEFAULT {_literal(into)};
  DECLARE open_date DATE DEFAULT DATE {_literal(spec.open_date)};
  DECLARE source_rows BIGINT;
  SET source_rows = (SELECT COUNT(*) FROM IDENTIFIER(source_table));
  IF source_rows > 0 THEN
    INSERT OVERWRITE TABLE IDENTIFIER(into_table) {body.replace(":open_date", "open_date")};
  END IF;
END"""


def run_overwrite_script(spark: SparkSession, into: str, target: str, source: str,
                         spec: HistorySpec) -> None:
    spark.sql(overwrite_script(into, target, source, spec)).collect()
