"""Ranked lexical search with the best position algorithm over impact lists.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, with only A-Z lower-cased. A
document's score for an item is the sum, over the item's terms, of weight x impact, where the impact
(10^9 tf) div (1000 tf + 20 m) lies between 0 and 10^6 and hangs on the document's length; all of it is whole-number
arithmetic, save the logarithm in the weight.

All words of all documents meet the items' vocabulary, which leaves one row per document with its hits, and the
statistics (documents, words, document frequencies) of the whole table. Documents are then dealt into shards, bounded by rows and by words. A shard
holds, for each term, a list of its documents in falling order of impact, and for each document its place in every
list. For an item, each list is read at the position right after its best position, which is the last one up to which
all positions have been seen; a document met is looked up in all other lists (direct access), which marks its
positions there as seen too and so pushes best positions on without reading. No unmet document can score more than the
sum of the weighted impacts at the best positions. The search stops when that sum is strictly below the k-th score.
Reads start at ``STEP`` positions per list and double.

Null and empty texts, and those without a term, are no documents for the statistics. Documents of null doc_id count in the statistics and are not listed. Rows that repeat a doc_id are documents each; equal rows (id and
text) are computed once and listed as often as they occur, ties by the order of doc_id. Items of null item_id take no part; rows that repeat an item_id are one item.
Items without a term, or with none that a document holds, have no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.storage import saved
from chronofold.llm.streams import ASKED, HELD, answered

#: Fixed values of the term pattern, of a document's m, and of an item's list.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RANKS = 50
#: Bounds of a shard, and positions that are read of each list in the first round.
SHARD_DOCS, SHARD_WORDS, STEP = 8192, 4_000_000, 16
#: Stands for a document as a whole among its hits.
_MARK = -1


class ImpactLists:
    """One shard. Entries lie twice: by term in falling impact, and by document with their place in the term's list."""

    def __init__(self, doc_ids: np.ndarray, lengths: np.ndarray, owner: np.ndarray, terms: np.ndarray, counts: np.ndarray):
        """``owner`` is the row of ``doc_ids`` that an entry belongs to, ``lengths`` holds each document's m."""
        by_id = np.argsort(doc_ids, kind="stable")
        place = np.empty(len(by_id), dtype=np.int64)
        place[by_id] = np.arange(len(by_id))
        self.doc_ids, self.source_rows, owner = doc_ids[by_id], by_id, place[owner]
        by_doc = np.argsort(owner, kind="stable")
        owner, counts = owner[by_doc], counts[by_doc]
        self.terms, self.doc_term = np.unique(terms[by_doc], return_inverse=True)
        self.doc_impact = (1_000_000_000 * counts) // (1000 * counts + 20 * lengths[by_id][owner])
        self.doc_from = np.searchsorted(owner, np.arange(len(doc_ids) + 1))
        falling = np.lexsort((owner, -self.doc_impact, self.doc_term))
        self.list_doc, self.list_impact = owner[falling], self.doc_impact[falling]
        self.list_from = np.searchsorted(self.doc_term[falling], np.arange(len(self.terms) + 1))
        self.doc_position = np.empty(len(falling), dtype=np.int64)
        self.doc_position[falling] = np.arange(len(falling)) - self.list_from[self.doc_term[falling]]
        self.slots = np.full(len(self.terms), -1, dtype=np.int64)
        #: Documents scored so far, for measuring how much the bound saves.
        self.accesses = 0

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows (in the order of doc_id) and scores of the k best documents with a score above 0, best first."""
        at = np.searchsorted(self.terms, terms)
        held = (at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == terms) if len(self.terms) else np.zeros(len(terms), bool)
        at, weights = at[held], weights[held]
        begins, sizes = self.list_from[at], self.list_from[at + 1] - self.list_from[at]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        seen, reached = np.zeros(offsets[-1], dtype=bool), np.zeros(len(at), dtype=np.int64)
        self.slots[at] = np.arange(len(at))
        rows, scores, step = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), STEP
        while (reached < sizes).any():
            docs = np.unique(np.concatenate([self._next(seen, begins[i], offsets[i], reached[i], min(sizes[i], reached[i] + step)) for i in np.flatnonzero(reached < sizes)]))
            found = self._scored(docs, weights, seen, offsets)
            rows, scores = np.concatenate([rows, docs[found > 0]]), np.concatenate([scores, found[found > 0]])
            first = np.lexsort((rows, -scores))[:k]
            rows, scores = rows[first], scores[first]
            for i in np.flatnonzero(reached < sizes):
                rest = seen[offsets[i] + reached[i] : offsets[i + 1]]
                gap = int(rest.argmin())
                reached[i] += len(rest) if rest[gap] else gap
            open_ = np.flatnonzero(reached < sizes)
            bound = int((weights[open_] * self.list_impact[begins[open_] + reached[open_] - 1]).sum())
            if len(rows) == k and bound < scores[-1]:
                break
            step *= 2
        self.slots[at] = -1
        return rows, scores

    def _next(self, seen: np.ndarray, begin: int, offset: int, a: int, b: int) -> np.ndarray:
        """Documents at the positions from a to b of a list that have not been seen yet."""
        return self.list_doc[begin + a + np.flatnonzero(~seen[offset + a : offset + b])]

    def _scored(self, docs: np.ndarray, weights: np.ndarray, seen: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whole scores by direct access, which marks the documents' positions in all lists of the item."""
        self.accesses += len(docs)
        sizes = self.doc_from[docs + 1] - self.doc_from[docs]
        ends = np.cumsum(sizes)
        entries = np.arange(ends[-1]) + np.repeat(self.doc_from[docs] - (ends - sizes), sizes)
        slot = self.slots[self.doc_term[entries]]
        mine = slot >= 0
        seen[offsets[slot[mine]] + self.doc_position[entries[mine]]] = True
        sums = np.concatenate([[0], np.cumsum(np.where(mine, weights[slot] * self.doc_impact[entries], 0))])
        return sums[ends] - sums[ends - sizes]


def _exploded(rows: DataFrame, terms: Column, *keep: Column | str) -> DataFrame:
    """One row per term of ``terms``, with A-Z lower-cased."""
    term = F.when(F.col("__term").rlike("[A-Z]"), F.translate("__term", _UPPER, _LOWER)).otherwise(F.col("__term"))
    return rows.select(*keep, F.explode(terms).alias("__term")).withColumn("term", term).drop("__term")


def _terms(text: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TERM), F.lit(0))


def _hits(documents: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """doc_id, words, copies, hits: one row per different (doc_id, text), with the counts of the vocabulary's terms in one copy.

    The vocabulary is a written table, so its size is known: words meet it where they are read, unless it is large.
    """
    words = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), _terms("text").alias("terms"))
    words = words.withColumn("words", F.size("terms").cast("long"))
    # the empty word, which is no term, stands for the document itself
    flat = _exploded(words, F.concat(F.array(F.lit("")), "terms"), "doc_id", "text_hash", "words")
    document = ["doc_id", "text_hash", "words"]
    counted = flat.join(vocabulary, "term").groupBy(*document, "term_id").agg(F.count(F.lit(1)).alias("n"))
    whole = counted.groupBy(*document).agg(
        F.max(F.when(F.col("term_id") == _MARK, F.col("n"))).alias("copies"),
        F.collect_list(F.when(F.col("term_id") != _MARK, F.struct("term_id", "n"))).alias("hits"))
    in_one = F.expr("transform(hits, x -> named_struct('term_id', x.term_id, 'n', x.n div copies))")
    return whole.select("doc_id", "words", "copies", in_one.alias("hits"))


def _weights(hits: DataFrame, documents: int) -> DataFrame:
    """term_id, weight of the terms that weigh anything."""
    frequency = hits.select("copies", F.explode("hits").alias("hit")).groupBy(F.col("hit.term_id").alias("term_id")).agg(F.sum("copies").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double")))
    return frequency.select("term_id", weight.cast("long").alias("weight")).where("weight > 0")


def _flat_hits(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner row, term_id and number of every entry of the hits column."""
    lists = rows["hits"].combine_chunks()
    entries = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    return owner, entries.field("term_id").to_numpy(zero_copy_only=False), entries.field("n").to_numpy(zero_copy_only=False)


def ranked(documents: DataFrame, items: DataFrame, k: int = RANKS, shard_docs: int = SHARD_DOCS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k highest-scoring documents with a score above 0."""
    asked = _exploded(items.where("item_id is not null"), _terms("text"), "item_id").distinct()
    terms = asked.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id())
    vocabulary = saved(terms.unionByName(items.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(_MARK).cast("long").alias("term_id"))))
    hits = saved(_hits(documents, vocabulary))
    some = F.when(F.col("words") > 0, F.col("copies"))
    n_docs, n_words, rows = hits.agg(F.coalesce(F.sum(some), F.lit(0)), F.coalesce(F.sum(F.col("words") * F.col("copies")), F.lit(0)), F.count(F.lit(1))).first()
    shards = max(1, math.ceil(rows / shard_docs), math.ceil(n_words / shard_words))

    weighed = asked.join(vocabulary, "term").join(_weights(hits, n_docs), "term_id")
    questions = weighed.groupBy("item_id").agg(F.collect_list(F.struct("term_id", F.col("weight").alias("n"))).alias("hits"))
    questions = questions.select(F.col("item_id").alias("id"), F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("copies"), "hits", F.lit(ASKED).alias("kind"))
    shard = F.pmod(F.xxhash64("doc_id", "words", "hits"), F.lit(shards)).cast("int")
    held = hits.where("doc_id is not null and size(hits) > 0").select(F.col("doc_id").alias("id"), "words", "copies", "hits", F.lit(HELD).alias("kind"), shard.alias("shard"))
    everything = held.unionByName(questions.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))

    def build(rows: pa.Table) -> tuple[ImpactLists, np.ndarray]:
        m = 100 - 50 + (50 * rows["words"].to_numpy() * n_docs) // n_words
        lists = ImpactLists(rows["id"].to_numpy(), m, *_flat_hits(rows))
        return lists, rows["copies"].to_numpy()[lists.source_rows]

    def answer(index: tuple[ImpactLists, np.ndarray], rows: pa.Table) -> dict:
        lists, copies = index
        owner, terms, weights = _flat_hits(rows)
        borders = np.searchsorted(owner, np.arange(rows.num_rows + 1))
        parts = [(np.zeros(0, dtype=np.int64),) * 4]
        for item_id, a, b in zip(rows["id"].to_pylist(), borders, borders[1:], strict=False):
            docs, scores = lists.best(terms[a:b], weights[a:b], k)
            parts.append((np.full(len(docs), item_id), lists.doc_ids[docs], scores, np.minimum(copies[docs], k)))
        return {name: pa.array(np.concatenate(column), pa.int64()) for name, column in zip(("item_id", "doc_id", "score", "copies"), zip(*parts, strict=True), strict=True)}

    found = answered(everything, ["shard"], build, answer, "item_id long, doc_id long, score long, copies long")
    found = found.select("item_id", "doc_id", "score", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
