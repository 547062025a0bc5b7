"""Searches of many queries in many shards, without holding more than one shard and one batch of queries.

Held rows (kind 0) and queries (kind 1) come as one table, partitioned by shard and sorted so that a shard's held rows
come first. A task reads its partition once, builds a shard's index when the shard's first query comes, and answers
the queries as they pass by, however many there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

HELD, ASKED = 0, 1


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """Slices of the batches in which the integer columns ``keys`` stay the same."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys])
        borders = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *borders], [*borders, batch.num_rows], strict=True):
            yield tuple(int(x) for x in columns[:, a]), batch.slice(a, b - a)


def answered(rows: DataFrame, shard: list[str], build: Callable, answer: Callable, schema: str) -> DataFrame:
    """``answer(build(held rows), queries)`` for every shard; both take an Arrow table, ``answer`` gives a dict of arrays.

    ``rows`` has the columns ``shard`` (integers without nulls) and ``kind``. A shard without held rows gives nothing.
    """

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, index = None, [], None
        for (*at, kind), part in runs(batches, [*shard, "kind"]):
            if at != now:
                now, held, index = at, [], None
            if kind == HELD:
                held.append(part)
                continue
            if index is None:
                if not held:
                    continue
                index, held = build(pa.Table.from_batches(held)), []
            yield pa.RecordBatch.from_pydict(answer(index, pa.Table.from_batches([part])))

    return rows.repartition(*shard).sortWithinPartitions(*shard, "kind").mapInArrow(search, schema)
