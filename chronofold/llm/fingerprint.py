"""Consistent weighted sampling: document fingerprints that collide as often as the documents are alike.

A document is the weighted set of its words (`[^\\x20\\x09-\\x0D]+`), each weighing its number of occurrences. For each
of ``SAMPLES`` draws a word gets gamma(2,1) variates r and c and a uniform b, all hashed from the word and the draw's
number, so equal words draw alike in every document. With t = floor(ln w / r + b), the draw takes the word of least
ln a = ln c - r (t - b) - r, and its signature is a hash of that word and t. Two documents agree in a draw with the
probability of their generalised Jaccard similarity, sum(min w) / sum(max w).

Null texts count as empty; a text without words has the empty fingerprint, which is like another such one by 1 and
like any other by 0. Rows that repeat a doc_id stand in the order of their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.ordering import BLOCK, in_blocks, next_blocks
from chronofold.llm.storage import saved

#: ROWS: of a block of neighbouring documents; many small blocks fill the partitions evenly. TOGETHER: draws that one
#: row of a word makes, so that a text's groups are looked up once for all of them; more make code that is too long to compile.
SAMPLES, ROWS, TOGETHER = 64, 128, 4
_26_BITS = (1 << 26) - 1
_SPLIT = r"[\x20\x09-\x0D]+"


def _uniforms(word: Column, sample: Column) -> tuple[Column, ...]:
    """Five numbers between 0 and 1 from two hashes of the word: 26, 26, 26, 26 and 24 bits."""
    one, two = F.xxhash64(word, 2 * sample), F.xxhash64(word, 2 * sample + 1)

    def low(h: Column) -> Column:
        return (h.bitwiseAND(F.lit(_26_BITS)) + 0.5) / float(1 << 26)

    def high(h: Column) -> Column:
        return (F.shiftrightunsigned(h, 26).bitwiseAND(F.lit(_26_BITS)) + 0.5) / float(1 << 26)

    last = (F.shiftrightunsigned(one, 52) * 4096 + F.shiftrightunsigned(two, 52) + 0.5) / float(1 << 24)
    return low(one), high(one), low(two), high(two), last


def _variates(word: Column, sample: Column) -> tuple[Column, Column, Column]:
    """r, ln c and b of a word's draw."""
    u1, u2, u3, u4, b = _uniforms(word, sample)
    return -F.log(u1 * u2), F.log(-F.log(u3 * u4)), b


def _draw(word: Column, ln_weight: Column, r: Column, ln_c: Column, b: Column) -> Column:
    """ln a, in steps of 2 ** -22, above 31 bits of the hash of (word, t). The least one over a text's words is taken."""
    t = F.floor(ln_weight / r + b)
    size = F.floor((ln_c - r * (t - b) - r + 128) * float(1 << 22))
    return F.shiftleft(size, 31).bitwiseOR(F.hash(word, t).cast("long").bitwiseAND(F.lit((1 << 31) - 1)))


def sampled(texts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per value of ``keys`` with, for each of the text columns, its array of signatures (empty without words).

    If the table already lies dealt by one of the keys, nothing is shuffled.
    """
    sides = F.array(*(F.struct(F.col(c).alias("text"), F.lit(i).alias("side")) for i, c in enumerate(columns)))
    parts = texts.select(*keys, F.explode(sides).alias("part"))
    words = parts.select(*keys, "part.side", F.explode_outer(F.split("part.text", _SPLIT)).alias("word"))
    words = words.select(*keys, "side", F.when(F.col("word") != "", F.xxhash64("word")).alias("word"))
    weights = [F.sum(F.when((F.col("side") == i) & F.col("word").isNotNull(), 1)).alias(f"w{i}") for i in range(len(columns))]
    terms = words.groupBy(*keys, "word").agg(*weights)
    logs = [F.log(f"w{i}").alias(f"ln_w{i}") for i in range(len(columns))]
    draws = terms.select(*keys, "word", *logs, F.explode(F.array(*(F.lit(k) for k in range(0, SAMPLES, TOGETHER)))).alias("draw"))
    # as columns of their own, so that they are computed once for all of the texts
    variates = [x.alias(f"{name}{k}") for k in range(TOGETHER) for x, name in zip(_variates(F.col("word"), F.col("draw") + k), ("r", "ln_c", "b"), strict=True)]
    draws = draws.select("*", *variates)
    least = [[F.min(_draw(F.col("word"), F.col(f"ln_w{i}"), F.col(f"r{k}"), F.col(f"ln_c{k}"), F.col(f"b{k}"))) for k in range(TOGETHER)] for i in range(len(columns))]
    drawn = draws.groupBy(*keys, "draw").agg(*(F.array(*m).alias(f"m{i}") for i, m in enumerate(least)))
    values = F.struct("draw", *(f"m{i}" for i in range(len(columns))))
    drawn = drawn.groupBy(*keys).agg(F.sort_array(F.collect_list(values)).alias("drawn"))

    def signature(i: int) -> Column:
        low = F.transform(F.flatten(F.transform("drawn", lambda d: d[f"m{i}"])), lambda m: m.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))
        return F.when(F.col("drawn")[0][f"m{i}"][0].isNull(), F.array().cast("array<int>")).otherwise(low).alias(columns[i])

    return drawn.select(*keys, *(signature(i) for i in range(len(columns))))


def likeness(one: str, other: str) -> Column:
    """The share of draws in which two fingerprints agree."""
    equal = F.expr(f"aggregate(zip_with(`{one}`, `{other}`, (a, b) -> if(a = b, 1, 0)), 0, (s, x) -> s + x)")
    empty, no = F.size(one) == 0, F.size(other) == 0
    return F.when(empty & no, F.lit(1.0)).when(empty | no, F.lit(0.0)).otherwise(equal / float(SAMPLES))


def as_text(fingerprint: str) -> Column:
    return F.expr(f"array_join(transform(`{fingerprint}`, x -> lpad(lower(hex(x)), 8, '0')), '')")


def with_next_text(docs: DataFrame) -> DataFrame:
    """(block, place, doc_id, text, next_text, next_block, next_place) of every row in ascending doc_id, the last before the first.

    The first row of each block is also put at the end of the block before, so that one shuffle of the texts is enough.
    """
    blocked = in_blocks(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", ROWS)
    order = Window.partitionBy(BLOCK).orderBy("doc_id", "text")
    heads = blocked.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")
    before = next_blocks(blocked.select("doc_id", "__group", BLOCK)).withColumnsRenamed({BLOCK: "__home", "following": BLOCK})
    ghosts = heads.join(before, BLOCK).select("doc_id", "text", F.col("__home").alias("block"), F.col(BLOCK).alias("home"), F.lit(1).alias("ghost"))
    rows = blocked.select("doc_id", "text", F.col(BLOCK).alias("block"), F.col(BLOCK).alias("home"), F.lit(0).alias("ghost")).unionByName(ghosts)
    order = Window.partitionBy("block").orderBy("ghost", "doc_id", "text")
    place = F.row_number().over(order)
    rows = rows.select(
        "block", place.alias("place"), "doc_id", "text", "ghost", F.lead("text").over(order).alias("next_text"),
        F.lead("home").over(order).alias("next_block"), F.when(F.lead("ghost").over(order) == 1, 1).otherwise(place + 1).alias("next_place"),
    )
    return rows.where("ghost = 0").drop("ghost")


def fingerprints(docs: DataFrame) -> DataFrame:
    """For each row of ``documents`` its fingerprint, that of its edited text, and how alike they and its successor's are."""
    n, quarter = F.length("text"), F.expr("length(text) div 4")
    rows = with_next_text(docs).withColumn("n_chars", n.cast("long"))
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = rows.withColumn("edited", edited)
    # true of every row: both branches below so need the same columns of the dealt texts, which are then shuffled once
    rows = rows.where("next_block is not null or place > 0")
    keys = ["block", "place"]
    drawn = sampled(rows.select(*keys, F.col("text").alias("fingerprint"), F.col("edited").alias("edited_fingerprint")), keys, ["fingerprint", "edited_fingerprint"])
    facts = rows.select(*keys, "doc_id", "n_chars", "next_block", "next_place", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    whole = saved(facts.join(drawn, keys))
    following = whole.select(F.col("block").alias("next_block"), F.col("place").alias("next_place"), F.col("fingerprint").alias("next_fingerprint"))
    return whole.join(following, ["next_block", "next_place"], "left").select(
        "doc_id", "n_chars", "edited_sha256", as_text("fingerprint").alias("fingerprint"), as_text("edited_fingerprint").alias("edited_fingerprint"),
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
