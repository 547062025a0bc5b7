"""Best-fit packing of documents into sequences, certified by lower bounds.

Documents longer than a sequence are cut into full pieces and a rest; nothing else is cut. The pieces are dealt into
partitions of about ``PART`` by a hash. Each partition is packed best-fit decreasing, and dual feasible functions give
a number of sequences that no packing of its pieces can go below. A partition that needs exactly so many is certified.
Those with a gap give their loosest sequences back; the pieces of several such partitions meet in one and are packed
again, for ``ROUNDS`` rounds or until no gap is left. At the end the loosest sequences of all partitions meet in a tree:
``MEET`` groups at a time are packed into one, which passes its own loosest on, until one group is left. Loose are
sequences that are less than ``LOOSE`` full; of these a group gives the loosest that hold about ``PART`` / ``MEET``
pieces, so that no group has many more than ``PART``, whatever the pieces' lengths. A repacking that needs no fewer
sequences than before leaves them as they are.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.storage import saved
from chronofold.llm.tokens import encoder

VOCABULARY, END, CAPACITY = "word_bpe_49k.json", 1, 4096
PART, ROUNDS, LOOSE, MEET = 100_000, 2, 0.98, 16
_PIECES = "doc_id long, copy int, piece int, start long, length long, ids_crc32 long"
_STATE = _PIECES + ", part long, bin long, gap int"


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end: int = END, ids: bool = False) -> DataFrame:
    """The pieces of every row's tokens (a null text: only the end id), with ``ids`` also their bytes.

    ``copy`` tells rows of one batch that repeat a doc_id apart, so that the deal does not hang on their order.
    """
    last = np.array([end], dtype="<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            copies = batch.groupby("doc_id", dropna=False).cumcount()
            rows = []
            texts = [None if x is None or x != x else x for x in batch["text"]]
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                for doc_id, copy, tokens in zip(part["doc_id"], copies.iloc[at : at + 200], encoder(vocabulary).encode(texts[at : at + 200]), strict=True):
                    tokens += last
                    for k, start in enumerate(range(0, len(tokens) // 4, capacity)):
                        some = tokens[4 * start : 4 * (start + capacity)]
                        rows.append((doc_id, copy, k, start, len(some) // 4, zlib.crc32(some), *([some] if ids else [])))
            out = pd.DataFrame(rows, columns=["doc_id", "copy", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])])
            out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
            yield out

    return docs.select("doc_id", "text").mapInPandas(cut, _PIECES + (", ids binary" if ids else ""))


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item; items come in falling length, each goes to the fullest bin that still holds it."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free room
    free, bins, out = 0, 0, np.empty(len(lengths), dtype=np.int64)  # free: bit r is set if a bin has room r
    for at, length in enumerate(lengths.tolist()):
        fits = free >> length
        if fits:
            r = length + (fits & -fits).bit_length() - 1
            chosen = room[r].pop()
            if not room[r]:
                free ^= 1 << r
        else:
            r, chosen, bins = capacity, bins, bins + 1
        left = r - length
        if left:
            room[left].append(chosen)
            free |= 1 << left
        out[at] = chosen
    return out


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best bound of two families of dual feasible functions: no packing needs fewer bins."""
    sizes, counts = np.unique(lengths, return_counts=True)
    if not len(sizes):
        return 0
    best = math.ceil(int((sizes * counts).sum()) / capacity)
    for k in range(1, 21):  # rounding: (k + 1) x / capacity if whole, else its floor over k
        scaled = sizes * (k + 1)
        exact = scaled % capacity == 0
        value = np.where(exact, sizes * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    for least in sizes[sizes <= capacity // 2]:  # threshold: what leaves less than ``least`` counts a bin, less than it nothing
        value = np.where(sizes > capacity - least, capacity, np.where(sizes < least, 0, sizes))
        best = max(best, -(-int((value * counts).sum()) // capacity))
    return best


def _packed(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    group = group.sort_values(["length", "doc_id", "piece", "ids_crc32", "copy"], ascending=[False, True, True, True, True], kind="stable")
    lengths = group["length"].to_numpy()
    bins = best_fit(lengths, capacity)
    return group.assign(bin=bins, gap=int(bins.max()) + 1 - lower_bound(lengths, capacity))


def _repacked(group: pd.DataFrame, capacity: int, part: int) -> pd.DataFrame:
    """The group as one partition: packed anew if that saves a bin, else in the bins it had."""
    old = group.groupby(["part", "bin"]).ngroup()
    new = _packed(group, capacity)
    bins, least = int(old.max()) + 1, int(new["bin"].max()) + 1 - int(new["gap"].iloc[0])
    return new.assign(part=part) if new["bin"].max() + 1 < bins else group.assign(part=part, bin=old, gap=bins - least)


def _loosest(bins: DataFrame, meet: int) -> DataFrame:
    """Of the bins (part, bin, fill, n) of each partition the loosest that hold about PART / meet pieces."""
    before = F.sum("n").over(Window.partitionBy("part").orderBy("fill", "bin").rowsBetween(Window.unboundedPreceding, -1))
    return bins.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < max(1, PART // meet)).select("part", "bin")


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add (sequence_id, offset) to pieces that have (doc_id, copy, piece, start, length, ids_crc32)."""
    columns = [c.split()[0] for c in _STATE.split(", ")]
    parts = max(1, math.ceil(rows.count() / PART))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "copy"), F.lit(parts)))
    state = saved(dealt.groupBy("part").applyInPandas(lambda g: _packed(g.assign(bin=0, gap=0), capacity)[columns], _STATE))
    names = parts

    def loose(state: DataFrame) -> DataFrame:
        bins = state.groupBy("part", "bin").agg(F.sum("length").alias("fill"), F.count(F.lit(1)).alias("n"))
        return bins.where(F.col("fill") < LOOSE * capacity)

    def again(state: DataFrame, open_bins: DataFrame, groups: int) -> DataFrame:
        """Pack the open bins again, those of every ``groups``-th partition together."""
        nonlocal names
        base, names = names, names + groups
        chosen = state.join(open_bins, ["part", "bin"], "left_semi").withColumn("meet", F.pmod("part", F.lit(groups)))
        moved = chosen.groupBy("meet").applyInPandas(lambda g: _repacked(g.drop(columns="meet"), capacity, base + int(g["meet"].iloc[0]))[columns], _STATE)
        return saved(state.join(open_bins, ["part", "bin"], "left_anti").unionByName(moved))

    if parts > 1:
        for k in range(ROUNDS):
            meet = MEET * (k + 1)
            open_bins = loose(state.where("gap > 0"))
            if open_bins.isEmpty():
                break
            groups = math.ceil(names / meet)
            state = again(state, _loosest(open_bins, math.ceil(names / groups)), groups)
        first = 0  # the partitions from here on are those of the tree's level
        while names - first > 1:
            members = names - first
            groups = math.ceil(members / MEET)
            first, state = names, again(state, _loosest(loose(state.where(F.col("part") >= first)), math.ceil(members / groups)), groups)
    return state.groupBy("part").applyInPandas(_placed, _PIECES + ", sequence_id long, offset long")


def _placed(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["bin", "length", "doc_id", "piece"], kind="stable")
    offset = group.groupby("bin")["length"].cumsum() - group["length"]
    out = group.assign(sequence_id=group["part"] * (1 << 32) + group["bin"], offset=offset)
    return out[["doc_id", "copy", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]


def packed_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every row with its place in a sequence."""
    return pack(saved(pieces(docs, capacity)), capacity).drop("copy")


def sequences(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences themselves, as bytes of little-endian 32-bit ids."""
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    with_ids = saved(pieces(docs, capacity, ids=True))
    # equal pieces of rows that repeat a doc_id have equal ids, whichever row they come from
    one_each = with_ids.drop("copy").dropDuplicates(keys).withColumnsRenamed({k: f"_{k}" for k in keys})
    placed = pack(with_ids.drop("ids"), capacity).join(one_each, F.expr(" and ".join(f"{k} <=> _{k}" for k in keys)))
    joined = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("n_tokens"))
    return joined.select("sequence_id", "n_tokens", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"))
