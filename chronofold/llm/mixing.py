"""Mixing sources to target weights.

The words of each source, in ascending doc_id, are packed into blocks of ``BLOCK_WORDS``; the last block of a source
may be shorter. Sources in the order of their code points, null last, weigh 1, 2, 3, 1, 2, ... and share the words of
the whole table; no source is asked for more than three times its words, and what it can't give is shared again.

The mix is a row of output shards of ``SHARD_SLOTS`` slots. The source counts of a shard are a multinomial draw given
the totals that the targets ask for: shards are halved again and again, each half drawing its part of what is left of
every source (`multivariate hypergeometric`), so any shard finds its counts alone and the totals are met. Slots of a
source are numbered through all shards; slot t takes the block that an index permutation of the source and of the
pass (t div blocks) maps t to, so a block is used at most once in a pass. The last slot takes part of its block.

Null texts and texts without words have size 0 and are never taken. Rows that repeat a doc_id stand in the order of
their texts' hashes. Everything hangs on ``SEED`` and the table alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.ordering import running_total
from chronofold.llm.storage import saved

BLOCK_WORDS, SHARD_SLOTS, WEIGHTS, MOST, SEED = 128, 4096, (1, 2, 3), 3, 20
#: Of these at least one does not divide a number of blocks, and then it has no divisor in common with it.
_PRIMES = (1000003, 1000033, 1000037, 1000039, 1000081, 1000099)
_SPACE = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """The number of runs of other characters than 0x20 and 0x09-0x0D."""
    whole = F.coalesce(text, F.lit(""))
    edges = (whole.rlike(r"\A[\x20\x09-\x0D]") | (whole == "")).cast("int") + whole.rlike(r"[\x20\x09-\x0D]\z").cast("int")
    return (F.size(F.split(whole, _SPACE)) - edges).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) with ``number``, ``weight`` and ``target``: one row a source.

    The targets are min(3 size, level x weight) with the one level at which they add up to all words. Sources are
    ranked by the level at which they would reach their limit; the level is that of the first rank at which the next
    source stays below its limit.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    rows = sizes.withColumn("number", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), F.col("number") % len(WEIGHTS) + 1)
    rows = rows.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(MOST)).withColumn("reach", F.col("limit") / F.col("weight"))
    order = Window.orderBy("reach", "number")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    since = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(since)
    rows = rows.withColumn("level", level)
    rows = rows.withColumn("level", F.min(F.when(F.col("level") <= F.col("reach"), F.struct("reach", "number", "level"))).over(every)["level"])
    target = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return rows.select("source", "number", "source_size", "weight", target.alias("target"))


def _half(counts: np.ndarray, slots: int, seed: tuple[int, ...]) -> np.ndarray:
    """How many of each source's slots fall to the first part of a run of shards."""
    rng, n, left = np.random.default_rng(seed), int(counts.sum()), slots
    if n < 10**9:
        return rng.multivariate_hypergeometric(counts, slots, method="marginals")
    # beyond the generator's range one source after the other: small ones binomially, large ones normally, within what is left
    first = np.zeros_like(counts)
    for k, count in enumerate(counts.tolist()):
        share = left / n if n else 0.0
        if count < n / 1000:
            drawn = int(rng.binomial(count, share))
        else:
            drawn = round(rng.normal(count * share, math.sqrt(max(0.0, count * share * (1 - share) * (1 - count / n))))) if n else 0
        n -= count
        first[k] = min(max(drawn, left - n, 0), count, left)
        left -= int(first[k])
    return first


def shard_counts(shard: int, shards: int, counts: np.ndarray, seed: int = SEED, slots: int = SHARD_SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Per source the number of the shard's slots, and how many slots of the source the shards before it hold."""
    counts, before = counts.copy(), np.zeros_like(counts)
    low, high = 0, shards
    while high - low > 1:
        middle = (low + high) // 2
        first = _half(counts, (middle - low) * slots, (seed, low, high))
        if shard < middle:
            counts, high = first, middle
        else:
            counts, before, low = counts - first, before + first, middle
    return counts, before


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their place in their source, the sources with their targets, and the slots of the mix.

    Rows: doc_id, source, copy (a hash of the text), size, number, at (words of the source before it).
    Slots: shard, number (of the source), slot, pass, block, words.
    """
    rows = saved(docs.select("doc_id", "source", F.xxhash64("text").alias("copy"), word_count(F.col("text")).alias("size")))
    sources = saved(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))))
    numbered = rows.join(sources.select("number", F.col("source").alias("__name")), F.col("source").eqNullSafe(F.col("__name"))).drop("__name")
    placed = saved(running_total(numbered, "size", "doc_id", "at", by=["number"], ties=["copy"]))
    # one row a source: the list of a corpus's sources is what the targets are set for, and is held by every task
    listed = sources.where("source_size > 0").orderBy("number").select("number", "source_size", "target").collect()
    spark = docs.sparkSession
    schema = "shard long, number int, slot long, pass long, block long, words int"
    if not listed:
        return placed, sources, spark.createDataFrame([], schema)
    number = np.array([r.number for r in listed])
    words = np.array([r.source_size for r in listed], dtype=np.int64)
    blocks = -(-words // BLOCK_WORDS)
    wanted = np.minimum(np.floor(np.array([r.target for r in listed]) + 1e-9).astype(np.int64), MOST * words)
    full, rest = wanted // words, wanted % words
    counts = full * blocks + -(-rest // BLOCK_WORDS)
    total = int(counts.sum())
    shards = max(1, -(-total // SHARD_SLOTS))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"].tolist():
                n, before = shard_counts(shard, shards, counts)
                some = np.flatnonzero(n)
                yield pd.DataFrame({"shard": shard, "number": number[some].astype(np.int32), "first": before[some], "n": n[some], "blocks": blocks[some], "source_size": words[some], "wanted": wanted[some]})

    drawn = spark.range(0, shards, 1, max(1, min(shards, 2000))).mapInPandas(draw, "shard long, number int, first long, n long, blocks long, source_size long, wanted long")
    slots = drawn.withColumn("slot", F.explode(F.expr("sequence(first, first + n - 1)"))).withColumn("pass", F.expr("slot div blocks"))
    # the last block, which may be short, stays last in each pass; the others are permuted: t -> (a t + c) mod (blocks - 1)
    among, place = F.col("blocks") - 1, F.expr("slot % blocks")
    factor = F.coalesce(*(F.when(among % p != 0, F.lit(p)) for p in _PRIMES)).cast("long")
    shift = F.pmod(F.xxhash64(F.lit(SEED), "number", "pass"), F.greatest(among, F.lit(1)))
    block = F.when(place == among, among).otherwise((place * factor + shift) % F.greatest(among, F.lit(1)))
    room = F.least(F.lit(BLOCK_WORDS), F.col("source_size") - block * BLOCK_WORDS)
    left = F.col("wanted") - F.col("pass") * F.col("source_size") - place * BLOCK_WORDS
    return placed, sources, slots.select("shard", "number", "slot", "pass", block.alias("block"), F.least(room, left).cast("int").alias("words"))


def _pieces(placed: DataFrame) -> DataFrame:
    """The rows cut at the block borders of their source: ``low`` and ``high`` count words of the block."""
    first, last = F.expr(f"at div {BLOCK_WORDS}"), F.expr(f"(at + size - 1) div {BLOCK_WORDS}")
    cut = placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    start = F.col("block") * BLOCK_WORDS
    return cut.withColumn("low", F.greatest(F.col("at") - start, F.lit(0))).withColumn("high", F.least(F.col("at") + F.col("size") - start, F.lit(BLOCK_WORDS)))


def taken_words(docs: DataFrame) -> DataFrame:
    """Per row of ``documents``: doc_id, size, its source's size and target, and the words that the mix takes of it."""
    placed, sources, slots = plan(docs)
    used = slots.groupBy("number", "block", "words").agg(F.count(F.lit(1)).alias("times"))
    part = F.greatest(F.least("high", "words") - F.col("low"), F.lit(0)) * F.col("times")
    # a source's rows with words begin at different words, so (number, at) names a row
    taken = _pieces(placed).join(used.hint("merge"), ["number", "block"]).groupBy("number", "at").agg(F.sum(part).alias("taken"))
    rows = placed.join(taken.hint("merge"), ["number", "at"], "left").withColumn("taken", F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long"))
    return rows.drop("source").join(sources, "number").select("doc_id", "size", "source_size", "target", "taken", "source", "weight")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: one row for each pass in which words of a document are taken, its text those words.

    A document of which a pass takes all keeps its text as it is there; of another, the words taken are joined by
    blanks. All other columns stay. Rows of which nothing is taken go.
    """
    placed, _, slots = plan(docs)
    part = F.least("high", "words") - F.col("low")
    used = _pieces(placed).join(slots.hint("merge"), ["number", "block"]).where(part > 0)
    begin = F.col("block") * BLOCK_WORDS + F.col("low") - F.col("at")
    ordered = Window.partitionBy("number", "at", "block").orderBy(F.desc(part), "pass")
    used = used.withColumn("turn", F.row_number().over(ordered))
    parts = used.groupBy("number", "at", "size", "turn").agg(F.sum(part).alias("n"), F.array_sort(F.collect_list(F.struct(begin.cast("int").alias("start"), part.cast("int").alias("n")))).alias("parts"))
    turns = parts.groupBy("number", "at").agg(F.collect_list(F.struct("turn", (F.col("n") == F.col("size")).alias("whole"), "parts")).alias("__turns"))
    # rows that repeat a doc_id, a source and a text are told apart by their number among the like
    like = F.xxhash64("doc_id", "source", "copy").alias("__like")
    nth = F.row_number().over(Window.partitionBy("__like").orderBy("at")).alias("__nth")
    rows = placed.where("size > 0").select("number", "at", like).select("number", "at", "__like", nth)
    turns = rows.join(turns.hint("merge"), ["number", "at"]).drop("number", "at")
    names = {c: f"d{i}" for i, c in enumerate(docs.columns)}
    text = names["text"]
    plain = docs.withColumnsRenamed(names)
    plain = plain.withColumn("__like", F.xxhash64(names["doc_id"], names["source"], F.xxhash64(text)))
    plain = plain.withColumn("__nth", F.row_number().over(Window.partitionBy("__like").orderBy(F.lit(0))))
    mixed = plain.join(turns.hint("merge"), ["__like", "__nth"]).select(*names.values(), F.explode("__turns").alias("__turn"))
    words = f"filter(split(`{text}`, r'{_SPACE}'), w -> w != '')"
    some = F.expr(f"array_join(flatten(transform(array({words}), ws -> flatten(transform(__turn.parts, p -> slice(ws, p.start + 1, p.n))))), ' ')")
    mixed = mixed.withColumn(text, F.when(F.col("__turn.whole"), F.col(text)).otherwise(some))
    return mixed.select(*(F.col(n).alias(c) for c, n in names.items()))
