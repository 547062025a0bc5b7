"""Token ids of a corpus in ascending doc_id, written as range-coded blocks and read back.

Documents are dealt by blocks of neighbouring ids (see `ordering`); in each, their ids run on from document to document
and are cut into coded blocks. The store is a folder of rows: the block of ids, the coded block's number in it, the
documents that it holds with their numbers of ids, and the coded block. Rows in the order of (part, number) are the
corpus in ascending doc_id; each can be read alone. The rows are kept as Parquet, so any store that Spark reads will do.

A null text counts as empty and has only its end id. Rows that repeat a doc_id stand in the order of their texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm import range_coder
from chronofold.llm.ordering import BLOCK, in_blocks, running_total
from chronofold.llm.storage import saved
from chronofold.llm.tokens import encoder

VOCABULARY, END = "byte_bpe_50k.json", 2
STORE = "part long, number long, docs array<struct<doc_id: long, place: long, ids: long>>, coded binary"


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END) -> DataFrame:
    """The rows of the store."""
    last = np.array([end], dtype="<u4").tobytes()

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready: list[tuple[int, int, list[dict], np.ndarray]] = []
        part, number, place, held, buffer, size = None, 0, 0, [], [], 0

        def cut(all_of_it: bool) -> None:
            nonlocal number, held, buffer, size
            while size >= range_coder.TOKENS or (all_of_it and size):
                ids = np.frombuffer(b"".join(buffer), dtype="<u4")
                some, room, inside = ids[: range_coder.TOKENS], range_coder.TOKENS, []
                while held and room:
                    doc_id, at, n = held[0]
                    inside.append({"doc_id": doc_id, "place": at, "ids": min(n, room)})
                    held[:1] = [(doc_id, at, n - room)] if n > room else []
                    room -= inside[-1]["ids"]
                ready.append((part, number, inside, some))
                number, buffer, size = number + 1, [ids[range_coder.TOKENS :].tobytes()], max(0, size - range_coder.TOKENS)

        def flushed() -> pd.DataFrame:
            blocks = range_coder.encode([r[3] for r in ready])
            out = pd.DataFrame({"part": [r[0] for r in ready], "number": [r[1] for r in ready], "docs": [r[2] for r in ready], "coded": blocks})
            ready.clear()
            return out

        for batch in batches:
            ids_of, texts = batch["doc_id"], batch["text"]
            for at in range(0, len(batch), 200):
                some = [None if t is None or t != t else t for t in texts.iloc[at : at + 200]]
                for its_part, doc_id, ids in zip(batch[BLOCK].iloc[at : at + 200], ids_of.iloc[at : at + 200], encoder(vocabulary).encode(some), strict=True):
                    if its_part != part:
                        cut(True)
                        part, number, place, held, buffer, size = its_part, 0, 0, [], [], 0
                    n = len(ids) // 4 + 1
                    held.append((None if pd.isna(doc_id) else int(doc_id), place, n))
                    place, size = place + 1, size + n
                    buffer += [ids, last]
                    if size >= 4 * range_coder.TOKENS:
                        cut(False)
                if len(ready) >= range_coder.LANES:
                    yield flushed()
        cut(True)
        if ready:
            yield flushed()

    blocked = in_blocks(docs.select("doc_id", "text"), "doc_id").select(BLOCK, "doc_id", "text")
    return blocked.repartition(BLOCK).sortWithinPartitions(BLOCK, "doc_id", "text").mapInPandas(coded, STORE)


def _pieces(store: DataFrame) -> DataFrame:
    """Each document's share of each coded block, from the decoded ids: number of ids, their crc32."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), range_coder.LANES):
                some = batch.iloc[at : at + range_coder.LANES]
                rows = []
                for part, number, docs, ids in zip(some["part"], some["number"], some["docs"], range_coder.decode(list(some["coded"])), strict=True):
                    raw, begin = ids.tobytes(), 0
                    for doc in docs:
                        own = raw[4 * begin : 4 * (begin + doc["ids"])]
                        begin += doc["ids"]
                        rows.append((part, doc["place"], doc["doc_id"], number, len(own) // 4, zlib.crc32(own)))
                yield pd.DataFrame(rows, columns=["part", "place", "doc_id", "number", "n", "crc"]).astype({"doc_id": "Int64"})

    return store.mapInPandas(read, "part long, place long, doc_id long, number long, n long, crc long")


def joined_crc(lengths: list[int], crcs: list[int]) -> int:
    """The crc32 of ids from those of their successive pieces."""
    whole = 0
    for n, crc in zip(lengths, crcs, strict=True):
        blank = bytes(4 * n)
        whole = zlib.crc32(blank, whole) ^ zlib.crc32(blank) ^ crc
    return whole


def digests(store: DataFrame) -> DataFrame:
    """Per document of the store: doc_id, start, n_tokens and ids_crc32."""

    @F.pandas_udf("long")
    def crc_of(pieces: pd.Series) -> pd.Series:
        return pd.Series([joined_crc([p["n"] for p in ps], [p["crc"] for p in ps]) for ps in pieces], dtype="int64")

    pieces = _pieces(store).groupBy("part", "place").agg(F.min("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("number", "n", "crc"))).alias("pieces"))
    one = F.when(F.size("pieces") == 1, F.col("pieces")[0]["crc"])
    many = pieces.withColumn("ids_crc32", F.coalesce(one, crc_of(F.transform("pieces", lambda p: F.struct(p["n"].alias("n"), p["crc"].alias("crc")))))).drop("pieces")
    return running_total(saved(many), "n_tokens", "doc_id", "start", ties=["place"]).select("doc_id", "start", "n_tokens", "ids_crc32")


def stored_documents(docs: DataFrame) -> DataFrame:
    """Write the table's store, read it back, and tell each document's place and checksum from it."""
    return digests(saved(encoded(docs)))
