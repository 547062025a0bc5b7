"""Toxicity by the nearest labelled examples, found exactly with a block-max inverted index.

Words are the runs of characters that are left when ASCII punctuation and white space are taken for blanks and letters
are lower-cased; the first ``STEM`` letters of a longer word are a term as well. Up to ``EXAMPLES`` labelled rows outside
fold ``HELD_OUT``, in the order of a hash, are the examples, as long as their distinct terms add up to ``TERMS`` at most;
both bound the model, not the texts it scores. All their terms are indexed, whatever label they lean to.

A term weighs (1 + ln tf) x ln(1 + N / df) x log2(2 + k / max(1, m)): N documents and df of them with the term, counted
over all documents, and the relevance frequency of k toxic and m other examples with it, which lets the few words that
tell outweigh some hundred others of a text. Examples and texts are vectors of length 1 over the terms of the examples.

The lists of rare terms are read whole. Those of terms that more than one in ``COMMON`` examples holds lie by block of
``BLOCK`` examples, as a matrix of weights with the greatest weight of each term. What the rare terms of a text give to
a block's best example and those greatest weights bound the block's cosines: first the blocks of the greatest bounds are
visited, then those whose bound reaches the ``NEAREST``-th best cosine found. Texts are searched together, so that a
block is visited once for all that need it. Visits are in single precision; what comes within their rounding error of
the nearest is computed again in double precision, so the neighbours are exact. They vote with their cosine; ``SHRINK`` votes of the examples' share of
toxic rows calibrate the score. A text without known terms, an empty or a null one among them, has no neighbours and
that share as its score. Ties go to the smaller doc_id.

Labels: a doc_id that is labelled more than once is toxic if one label says so; a null label is none. Without any
labels every score is 0. Rows of `documents` that repeat a doc_id and a text are one example, other texts of that doc_id
further ones.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from chronofold.llm.storage import fold_of, saved

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
EXAMPLES, TERMS, BLOCK, NEAREST, SHRINK, STEM = 4_000, 6_000_000, 64, 15, 0.5, 4
#: One in so many examples holds a common term; texts that are searched together, fewer if they have more postings than
#: that (a text alone has at most those of the index), and blocks that each visits before the bounds rule out others.
COMMON, TEXTS, POSTINGS, _FIRST_BLOCKS = 20, 64, 2_000_000, 8
RESULT = StructType([StructField("score", DoubleType()), StructField("evidence", StringType())])
_BLANKS = bytes(32 if chr(b) in string.punctuation else b for b in range(256))


def _words(text: str | None) -> list[str]:
    return text.lower().encode("utf-8", "replace").translate(_BLANKS).decode().split() if text else []


def terms(text: str | None) -> Counter:
    """Occurrences of the words and of the stems (first ``STEM`` letters and a star) of the longer ones."""
    counts = Counter(_words(text))
    stems: dict[str, int] = {}
    for word, n in counts.items():
        if len(word) > STEM:
            stem = word[:STEM] + "*"
            stems[stem] = stems.get(stem, 0) + n
    dict.update(counts, stems)  # no word ends with a star
    return counts


def relevance(toxic: np.ndarray, examples: np.ndarray) -> np.ndarray:
    """The factor of terms that so many toxic examples and so many examples in all hold."""
    return np.log2(2 + toxic / np.maximum(1, examples - toxic))


class NearestExamples:
    """The examples' index. rows: (doc_id, toxic, counts of terms); weights: of the terms; share: of toxic examples."""

    def __init__(self, rows: list[tuple[int, int, dict[str, int]]], weights: dict[str, float], share: float):
        self.share, names = share, sorted(weights)
        self.row = {w: k for k, w in enumerate(names)}
        self.weights = np.array([weights[w] for w in names], dtype=np.float64)
        rows = sorted(rows, key=lambda r: (r[0], r[1], sorted(r[2].items())))
        at, x, start = self._known([counts for _, _, counts in rows])
        sizes = np.diff(start)
        some = [k for k, (low, high) in enumerate(zip(start[:-1].tolist(), start[1:].tolist(), strict=True)) if x[low:high].any()]
        kept = np.isin(np.repeat(np.arange(len(rows)), sizes), some)
        self.ids = np.array([rows[k][0] for k in some], dtype=np.int64)
        self.labels = np.array([rows[k][1] for k in some], dtype=np.float64)
        self.blocks = -(-len(some) // BLOCK)
        # by example: its terms, rising, and their weights
        self.start = np.append(0, np.cumsum(sizes[some]))
        self.term, self.weight = at[kept].astype(np.int32), x[kept]
        self._arrange()

    def __getstate__(self) -> dict:
        """What ``_arrange`` makes is not sent to the workers: they make it again."""
        return {k: self.__dict__[k] for k in ("share", "row", "weights", "ids", "labels", "blocks", "start", "term", "weight")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._arrange()

    def _arrange(self) -> None:
        """The words' stems, the lists of the rare terms and the blocks of the common ones."""
        #: Each word's stem, -1 for short words and stems; the last place is for unknown words.
        self.stem = np.array([self.row.get(w[:STEM] + "*", -1) if len(w) > STEM and not w.endswith("*") else -1 for w in self.row] + [-1], dtype=np.int64)
        example = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(self.start))
        held = np.bincount(self.term, minlength=len(self.row))
        common = held * COMMON > len(self.ids)
        #: The place of a common term in the matrices, -1 for a rare one.
        self.place = np.where(common, np.cumsum(common) - 1, -1)
        dense = common[self.term]
        self.matrix = np.zeros((int(common.sum()), self.blocks * BLOCK), dtype=np.float32)
        self.matrix[self.place[self.term[dense]], example[dense]] = self.weight[dense]
        self.most = self.matrix.reshape(len(self.matrix), self.blocks, BLOCK).max(axis=2, initial=0)
        order = np.argsort(self.term[~dense], kind="stable")
        self.list_example, self.list_weight = example[~dense][order], self.weight[~dense][order]
        self.list_start = np.cumsum([0, *np.where(common, 0, held)])
        #: More than the rounding of a cosine in single precision, whatever the order of its sum.
        self.error = (len(self.matrix) + 8) * 2.0**-23

    def _known(self, counts: list[dict[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vectors of counted terms, see ``_vectors``."""
        sizes = [len(c) for c in counts]
        at = np.fromiter(chain.from_iterable(map(self.row.get, c, repeat(-1)) for c in counts), dtype=np.int64, count=sum(sizes))
        n = np.fromiter(chain.from_iterable(c.values() for c in counts), dtype=np.float64, count=sum(sizes))
        here = at >= 0
        return self._vectors(np.repeat(np.arange(len(counts)), sizes)[here], at[here], n[here], len(counts))

    def _read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vectors of ``terms`` of the texts. The index knows the stems of its words; only those of other words are looked up."""
        counts = [Counter(_words(t)) for t in texts]
        sizes = [len(c) for c in counts]
        words = list(chain.from_iterable(counts))
        at = np.fromiter(map(self.row.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        n = np.fromiter(chain.from_iterable(c.values() for c in counts), dtype=np.float64, count=len(words))
        stem = self.stem[at]
        other = np.flatnonzero(at < 0).tolist()
        stem[other] = [self.row.get(words[k][:STEM] + "*", -1) if len(words[k]) > STEM else -1 for k in other]
        text, n = np.tile(np.repeat(np.arange(len(texts)), sizes), 2), np.tile(n, 2)
        at = np.concatenate([at, stem])
        here = at >= 0
        return self._vectors(text[here], at[here], n[here], len(texts))

    def _vectors(self, text: np.ndarray, at: np.ndarray, n: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The numbers of the terms that the index knows, text by text and rising, their weights in vectors of length 1, and where each text begins."""
        cell, same = np.unique(text * max(len(self.row), 1) + at, return_inverse=True)
        n = np.bincount(same, n, minlength=len(cell))
        text, at = np.divmod(cell, max(len(self.row), 1))
        start = np.searchsorted(text, np.arange(texts + 1))
        x = (1 + np.log(n)) * self.weights[at]
        for low, high in zip(start[:-1].tolist(), start[1:].tolist(), strict=True):
            part = x[low:high]
            norm = math.sqrt(float(part @ part))
            if norm:
                part /= norm
        return at, x, start

    def nearest(self, counts: dict[str, int]) -> list[tuple[float, int]]:
        """(cosine, example) of the nearest, best first."""
        return self.nearest_of([counts])[0]

    def nearest_of(self, counts: list[dict[str, int]]) -> list[list[tuple[float, int]]]:
        """The nearest of each text, by its counted terms."""
        return self._search(*self._known(counts))

    def _search(self, at: np.ndarray, x: np.ndarray, start: np.ndarray) -> list[list[tuple[float, int]]]:
        size = len(start) - 1
        if not self.blocks or not size:
            return [[] for _ in range(size)]
        # the postings of all rare terms, text by text
        low = self.list_start[at]
        n = self.list_start[at + 1] - low
        if n.sum() > POSTINGS and size > 1:
            half, cut = size // 2, start[size // 2]
            return self._search(at[:cut], x[:cut], start[: half + 1]) + self._search(at[cut:], x[cut:], start[half:] - cut)
        texts = np.repeat(np.arange(size), np.diff(start))
        place = self.place[at]
        common = place >= 0
        asked = np.zeros((size, len(self.matrix)), dtype=np.float32)
        asked[texts[common], place[common]] = x[common]
        posting = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        cell = np.repeat(texts * self.blocks * BLOCK, n) + self.list_example[posting]
        found = np.bincount(cell, np.repeat(x, n) * self.list_weight[posting], minlength=size * self.blocks * BLOCK)
        by_block = found.astype(np.float32).reshape(size, self.blocks, BLOCK)
        bound = by_block.max(axis=2) + asked @ self.most + self.error
        first = min(_FIRST_BLOCKS, self.blocks)
        visit = np.zeros(bound.shape, dtype=bool)
        tops = np.argpartition(-bound, first - 1, axis=1)[:, :first]
        np.put_along_axis(visit, tops, True, axis=1)
        self._visit(asked, by_block, visit)
        seen = np.take_along_axis(by_block, tops[:, :, None], axis=1).reshape(size, -1)
        more = ~visit & (bound >= self._least(seen)[:, None] - self.error)
        self._visit(asked, by_block, more)
        visited = visit | more
        seen = np.where(visited[:, :, None], by_block, 0).reshape(size, -1)
        least = self._least(seen)
        whole, held, out = np.zeros(len(self.place)), np.zeros(len(self.place), dtype=bool), []
        for k in range(size):
            near = np.flatnonzero((seen[k] >= least[k] - 2 * self.error) & (seen[k] > 0))
            own = slice(start[k], start[k + 1])
            whole[at[own]], held[at[own]] = x[own], True
            out.append(self._best(self._cosines(whole, held, near), near))
            held[at[own]] = False
        return out

    def _visit(self, asked: np.ndarray, by_block: np.ndarray, visit: np.ndarray) -> None:
        """Add what the common terms give to the blocks that a text visits; where most visit most, by one product."""
        if 2 * visit.sum() > visit.size:
            by_block += np.where(visit[:, :, None], (asked @ self.matrix).reshape(by_block.shape), 0)
            return
        for block in np.flatnonzero(visit.any(axis=0)).tolist():
            who = np.flatnonzero(visit[:, block])
            by_block[who, block] += asked[who] @ self.matrix[:, block * BLOCK : (block + 1) * BLOCK]

    @staticmethod
    def _least(cosine: np.ndarray) -> np.ndarray:
        """The ``NEAREST``-th greatest of each row, or 0."""
        return np.partition(cosine, -NEAREST, axis=1)[:, -NEAREST] if cosine.shape[1] > NEAREST else np.zeros(len(cosine), dtype=cosine.dtype)

    def _cosines(self, whole: np.ndarray, held: np.ndarray, some: np.ndarray) -> np.ndarray:
        """The exact cosines of some examples; ``whole`` has the weights of the text's terms, ``held`` tells which they are."""
        lists = list(map(slice, self.start[some].tolist(), self.start[some + 1].tolist()))
        if not lists:
            return np.empty(0)
        term = np.concatenate([self.term[s] for s in lists])
        shared = np.flatnonzero(held[term])
        sizes = self.start[some + 1] - self.start[some]
        of = np.searchsorted(np.cumsum(sizes), shared, side="right")
        place = shared + (self.start[some] - (np.cumsum(sizes) - sizes))[of]
        return np.bincount(of, self.weight[place] * whole[term[shared]], minlength=len(some))

    def _best(self, cosine: np.ndarray, some: np.ndarray) -> list[tuple[float, int]]:
        """The ``NEAREST`` greatest above 0, best first; ties to the smaller number."""
        order = np.lexsort((some, -cosine))[:NEAREST]
        return [(c, i) for c, i in zip(cosine[order].tolist(), some[order].tolist(), strict=True) if c > 0]

    def score(self, text: str | None) -> tuple[float, str]:
        return self.scores([text])[0]

    def scores(self, texts: list[str | None]) -> list[tuple[float, str]]:
        """The calibrated votes and the neighbours behind them, as doc_id:cosine."""
        out = []
        for at in range(0, len(texts), TEXTS):
            for found in self._search(*self._read(texts[at : at + TEXTS])):
                vote, weight = sum(c * self.labels[i] for c, i in found), sum(c for c, _ in found)
                score = float(vote + SHRINK * self.share) / (weight + SHRINK)
                out.append((min(max(score, 0.0), 1.0), ",".join(f"{self.ids[i]}:{c:.3f}" for c, i in found[:3])))
        return out


def _texts(column: pd.Series) -> list[str | None]:
    return column.where(column.notna(), None).tolist()


def examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic, words and counts of the example rows, which ``EXAMPLES`` and ``TERMS`` bound."""
    usable = labels.where((fold_of(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    chosen = usable.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(EXAMPLES).collect()
    chosen = docs.sparkSession.createDataFrame([(r.doc_id, r.toxic) for r in chosen], "doc_id long, toxic int")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [sorted(terms(t).items()) for t in _texts(batch["text"])]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "words": [[w for w, _ in r] for r in rows], "counts": [[c for _, c in r] for r in rows]})

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "text"])
    rows = rows.mapInPandas(counted, "doc_id long, toxic int, words array<string>, counts array<int>")
    rows = saved(rows.withColumn("copy", F.xxhash64("words", "counts")))
    order = [F.xxhash64("doc_id"), "doc_id", "copy"]
    # one narrow row an example, so the running total fits one task
    first = rows.select("doc_id", "copy", F.size("words").alias("n")).orderBy(*order).limit(EXAMPLES)
    first = first.withColumn("upto", F.sum("n").over(Window.orderBy(*order))).where(F.col("upto") <= TERMS)
    return rows.join(F.broadcast(first.select("doc_id", "copy").distinct()), ["doc_id", "copy"], "left_semi").drop("copy")


def document_frequencies(docs: DataFrame, number: dict[str, int]) -> DataFrame:
    """(term, df): how many documents hold each of the numbered terms; term -1 stands for documents with any words."""
    known = docs.sparkSession.sparkContext.broadcast(number)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, some = Counter(), 0
        for batch in batches:
            for text in _texts(batch["text"]):
                words = set(_words(text))
                some += bool(words)
                words.update([w[:STEM] + "*" for w in words if len(w) > STEM])
                held.update(words & known.value.keys())
        yield pd.DataFrame({"term": [-1, *(known.value[w] for w in held)], "df": [some, *held.values()]})

    return docs.select("text").mapInPandas(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def learnt(docs: DataFrame, labels: DataFrame) -> NearestExamples:
    """The index over the examples; what reaches the driver is bounded as they are."""
    found = saved(examples(docs, labels)).toArrow()
    toxic = np.array(found["toxic"].to_pylist(), dtype=np.int64)
    if not len(toxic):
        return NearestExamples([], {}, 0.0)
    coded = found["words"].combine_chunks().flatten().dictionary_encode()
    names, term = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    counts = found["counts"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sizes = np.array([len(w) for w in found["words"]], dtype=np.int64)
    of_toxic = np.repeat(toxic, sizes)
    held, held_toxic = np.bincount(term, minlength=len(names)), np.bincount(term, of_toxic, minlength=len(names))
    over_all = document_frequencies(docs, {w: k for k, w in enumerate(names)}).toArrow()
    df = np.ones(len(names) + 1)
    df[over_all["term"].to_numpy()] = over_all["df"].to_numpy()  # the last place takes term -1
    weights = np.log(1 + df[-1] / df[:-1]) * relevance(held_toxic, held)
    ends = np.cumsum(sizes)
    rows = [(i, t, dict(zip([names[k] for k in term[e - n : e].tolist()], counts[e - n : e].tolist(), strict=True)))
            for i, t, e, n in zip(found["doc_id"].to_pylist(), toxic.tolist(), ends.tolist(), sizes.tolist(), strict=True)]
    return NearestExamples(rows, dict(zip(names, weights.tolist(), strict=True)), float(toxic.mean()))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every row of ``documents``."""
    index = docs.sparkSession.sparkContext.broadcast(learnt(docs, labels))

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(index.value.scores(_texts(batch)), columns=["score", "evidence"])

    found = F.pandas_udf(score, RESULT)("text").alias("found")
    rows = docs.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), found)
    return rows.select("doc_id", "held_out", "found.score", (F.col("found.score") >= THRESHOLD).cast("int").alias("predicted"), "found.evidence")
