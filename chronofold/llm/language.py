"""Language by cross-parsing: how many phrases of each language's own text does a text fall into?

Of each language, ``SAMPLE`` symbols of labelled text are learnt as a suffix automaton, which knows every passage of
it. A text is parsed from left to right into the longest passages that the automaton knows; with n symbols and c
phrases the cross-parsing entropy is c log2(``SAMPLE``) / n bits a symbol, and the language of least entropy wins.
Texts are lower-cased; what lies between letters counts as one blank. All texts of a batch are parsed side by side, in
stretches of ``STRETCH`` symbols, so a long text costs no more per symbol than a short one; a phrase ends with its
stretch.

A text that is null or has no letter is `und` with score 0. The score is 1 minus the ratio of the winner's entropy to
the runner-up's, brought to the range 0.5 to 1 (1 if only one language is learnt). Ties go to the first name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from chronofold.llm.kept import kept
from chronofold.llm.storage import fold_of

#: Symbols learnt of each language, and rows of it that they are taken from: bounds of the model, not of the texts judged.
SAMPLE, SAMPLE_ROWS = 20_000, 64
STRETCH, LANES, TEXTS, FOLDS = 2048, 2048, 1000, 5
UNKNOWN = "und"
RESULT = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def plain_symbols(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, each run of anything else as one blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = np.where(_letter(points), points, 32)
    blank = points == 32
    return points[~(blank & np.concatenate([[True], blank[:-1]]))] if len(points) else points


_LETTERS = np.zeros(0x110000, dtype=np.int8)  # 0: not asked yet, 1: letter, -1: other


def _letter(points: np.ndarray) -> np.ndarray:
    kind = _LETTERS[points]
    if not kind.all():
        for p in np.unique(points[kind == 0]).tolist():
            _LETTERS[p] = 1 if chr(p).isalpha() else -1
        kind = _LETTERS[points]
    return kind > 0


def suffix_automaton(symbols: list[int], size: int) -> np.ndarray:
    """The automaton's moves, a row for each state and a column for each symbol; -1: no passage goes on so."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        new, p = len(moves) - 1, last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                twin = len(moves) - 1
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    out = np.full((len(moves), size), -1, dtype=np.int32)
    for state, row in enumerate(moves):
        for c, to in row.items():
            out[state, c] = to
    return out


class CrossParser:
    """The automata of all languages over one alphabet, as one table of moves."""

    def __init__(self, texts: dict[str, list[int]]):
        self.languages = sorted(texts)
        letters = sorted({c for text in texts.values() for c in text})
        self.code = np.zeros(0x110000, dtype=np.uint16)  # 0: a symbol in no language's sample
        self.code[letters] = np.arange(1, len(letters) + 1)
        tables = [suffix_automaton(self.code[texts[name]].tolist(), len(letters) + 1) for name in self.languages]
        self.roots = np.cumsum([0, *(len(t) for t in tables[:-1])]).astype(np.int32)
        self.width = len(letters) + 1
        self.moves = np.concatenate([np.where(t < 0, -1, t + root) for t, root in zip(tables, self.roots, strict=True)]).astype(np.int32).ravel()
        self.bits = np.log2([max(len(texts[name]), 2) for name in self.languages])

    def phrases(self, stretches: list[np.ndarray]) -> np.ndarray:
        """Phrases of each stretch in each language."""
        order = np.argsort([-len(s) for s in stretches], kind="stable")
        lengths = np.array([len(stretches[i]) for i in order])
        symbols = np.zeros((lengths[0] if len(lengths) else 0, len(order)), dtype=np.int32)
        for lane, i in enumerate(order):
            symbols[: len(stretches[i]), lane] = self.code[stretches[i]]
        languages = len(self.languages)
        roots = np.tile(self.roots[:, None], (1, len(order)))
        state, count = roots.copy(), np.zeros((languages, len(order)), dtype=np.int64)
        for at, row in enumerate(symbols):
            lanes = int(np.searchsorted(-lengths, -at, side="left"))  # those of more than ``at`` symbols
            row, root = row[:lanes], roots[:, :lanes]
            to = self.moves[state[:, :lanes] * self.width + row]
            ended = to < 0
            # the phrase so far ends before this symbol, unless it is empty; an unknown symbol is a phrase of its own
            count[:, :lanes] += ended & (state[:, :lanes] != root)
            again = self.moves[root * self.width + row]
            alone = ended & (again < 0)
            count[:, :lanes] += alone
            state[:, :lanes] = np.where(ended, np.where(again < 0, root, again), to)
        out = np.empty_like(count)
        out[:, order] = count + (state != roots)
        return out

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Bits a symbol of each text (with a letter) in each language."""
        owner, stretches = [], []
        for i, text in enumerate(texts):
            symbols = plain_symbols(text)
            for at in range(0, max(len(symbols), 1), STRETCH):
                owner.append(i)
                stretches.append(symbols[at : at + STRETCH])
        counts, owner, size = np.zeros((len(self.languages), len(texts))), np.array(owner), np.array([len(s) for s in stretches])
        for at in range(0, len(stretches), LANES):
            np.add.at(counts.T, owner[at : at + LANES], self.phrases(stretches[at : at + LANES]).T)
        n = np.maximum(np.bincount(owner, weights=size, minlength=len(texts)), 1) if len(texts) else np.ones(0)
        return counts * self.bits[:, None] / n

    def judge(self, texts: list[str | None]) -> pd.DataFrame:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if known and self.languages:
            bits = self.entropies([texts[i] for i in known])
            best = bits.argmin(axis=0)
            ordered = np.sort(bits, axis=0)
            score = 1 - 0.5 * ordered[0] / np.maximum(ordered[1], 1e-12) if len(bits) > 1 else np.ones(len(known))
            for i, b, s in zip(known, best.tolist(), score.tolist(), strict=True):
                names[i], scores[i] = self.languages[b], min(max(s, 0.0), 1.0)
        return pd.DataFrame({"lang_pred": names, "score": scores})


def training_text(docs: DataFrame) -> dict[str, list[int]]:
    """Up to ``SAMPLE`` symbols of each language, from ``SAMPLE_ROWS`` of its rows outside fold 0, chosen by a hash."""
    labelled = docs.where(F.col("lang").isNotNull() & (fold_of(F.col("doc_id"), FOLDS) != 0) & F.col("doc_id").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    usable = labelled.where(F.col("text").rlike(r"\p{L}")).select("doc_id", "lang")
    chosen = usable.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= SAMPLE_ROWS).select("doc_id", "lang").collect()
    names = sorted({r.lang for r in chosen})
    ids = sorted({r.doc_id for r in chosen})
    rows = labelled.where(F.col("doc_id").isin(ids) & F.col("lang").isin(names)).select("lang", "doc_id", "text").where("text is not null").collect() if ids else []
    out = {}
    for name in names:
        texts = [plain_symbols(r.text) for r in sorted((r for r in rows if r.lang == name), key=lambda r: (r.doc_id, r.text))]
        texts = [t for t in texts if len(t)]
        share, left = [], SAMPLE
        for k, text in enumerate(sorted(texts, key=len)):  # short texts give all they have, long ones share the rest
            share.append(text[: max(1, left // (len(texts) - k))] if left > 0 else text[:0])
            left -= len(share[-1])
        out[name] = np.concatenate(share).tolist()
    return out


def predictions(docs: DataFrame, texts: dict[str, list[int]]):
    """A column function: text to (lang_pred, score). Workers build the automata from the sample once each."""
    sample = docs.sparkSession.sparkContext.broadcast(texts)

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = _parser(sample.value)
        for batch in batches:
            texts = batch.where(batch.notna(), None).tolist()
            parts = [parser.judge(texts[at : at + TEXTS]) for at in range(0, len(texts), TEXTS)]
            yield pd.concat(parts, ignore_index=True) if parts else parser.judge([])

    return F.pandas_udf(judge, RESULT)


def _parser(texts: dict[str, list[int]]) -> CrossParser:
    return kept(("parser", hash(tuple((name, tuple(texts[name])) for name in sorted(texts)))), lambda: CrossParser(texts))


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``documents``."""
    judge = predictions(docs, training_text(docs))
    rows = docs.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == 0).alias("held_out"), judge("text").alias("found"))
    return rows.select("doc_id", "held_out", "found.lang_pred", "found.score")


def in_a_known_language(docs: DataFrame) -> DataFrame:
    """The rows whose text is in some language: those that are `und` go. If no row is labelled, texts without a letter go."""
    texts = training_text(docs)
    if not texts:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return docs.where(predictions(docs, texts)("text")["lang_pred"] != UNKNOWN)
