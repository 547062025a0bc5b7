"""Token ids of whole texts, with the vocabularies of public tokenizers.

A vocabulary cuts a text into words before it merges within them, so a word's ids do not depend on its neighbours.
Each worker therefore keeps the ids of words. Most words come once only, so a word's are kept for good when it has come
again while among the last ``WORDS_NEW`` new ones; beyond ``WORDS_KEPT`` words these are forgotten too. A text whose white space could bind words together, or that may spell out a special token, is encoded as a whole. Both ways give the
ids of ``Tokenizer.encode(text, add_special_tokens=False)``, which the tests compare.
"""

from __future__ import annotations

import os
import re
import string
import sys
import unicodedata
from array import array

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from chronofold.llm.kept import kept

WORDS_KEPT, WORDS_NEW = 400_000, 300_000
_TAIL = re.compile(rf"[{re.escape(string.punctuation)}]+\Z")


def _plainly_spaced(text: str, words: list[str]) -> bool:
    """Whether one blank or line feed, and nothing else, stands between any two of the text's words (those of ``split``)."""
    return " ".join(words) == text.replace("\n", " ")


def _letters(word: str) -> bool:
    """Letters only, and still so after the normalisation that a vocabulary may apply."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes() if sys.byteorder == "big" else array("I", ids).tobytes()


class WordEncoder:
    """Ids of texts as little-endian 32-bit words. ``spaced``: a word's ids include those of the blank before it."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        #: How special tokens begin. A text that holds this is encoded as a whole: the library looks for them before it cuts words or lower-cases.
        self.special = {token.content[:2] for token in self.tokenizer.get_added_tokens_decoder().values()}
        self.spaced = bool(self.tokenizer.encode(" a", add_special_tokens=False).ids != self.tokenizer.encode("a", add_special_tokens=False).ids)
        self.lower = self.tokenizer.encode("A", add_special_tokens=False).ids == self.tokenizer.encode("a", add_special_tokens=False).ids
        #: Words that came again, and those that came once of late.
        self.known: dict[str, bytes] = {"": b""}
        self.new: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [_packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_parts(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of words or parts of them. ASCII letters are never cut or changed before the merges (if lower-cased, where they have to be)."""
        out: dict[str, bytes] = {}
        others, merged = [], self.tokenizer.model.tokenize
        for part in parts:
            if part.isascii() and part.removeprefix(" ").isalpha() and (part.islower() or not self.lower):
                out[part] = _packed([token.id for token in merged(part.replace(" ", "Ġ"))])  # how the byte vocabulary writes a blank
            else:
                others.append(part)
        out.update(zip(others, self._encoded(others), strict=True))
        return out

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words that are not known. Letters and the marks after them are separate words to either vocabulary; their ids are put together."""
        blank = " " if self.spaced else ""
        found: dict[str, bytes] = {}
        parts: dict[str, tuple[str, str]] = {}
        fresh = set()
        for word in set(words):
            if word in self.new:
                found[word] = self.known[word] = self.new.pop(word)
                continue
            tail = _TAIL.search(word)
            stem = word[: tail.start()] if tail else word
            parts[word] = (stem, tail.group()) if tail and _letters(stem.removeprefix(blank)) and stem.startswith(blank) else (word, "")
            fresh.update(p for p in parts[word] if p not in self.known and p not in self.new)
        self.new.update(self._of_parts(list(fresh)))
        for word, (a, b) in parts.items():
            first = self.known.get(a)
            ids = self.new[a] if first is None else first
            if b:
                second = self.known.get(b)
                ids += self.new[b] if second is None else second
                self.new[word] = ids
            found[word] = ids
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; none for a null or empty one."""
        if len(self.known) > WORDS_KEPT:
            self.known = {"": b""}
        if len(self.new) > WORDS_NEW:
            self.new = {}
        known = self.known
        out = []
        for text in texts:
            if not text:
                out.append(b"")
                continue
            plain = text.lower() if self.lower and text.isascii() else text
            words = plain.split()
            if not _plainly_spaced(plain, words) or any(s in text for s in self.special):
                out += self._encoded([text])
                continue
            if self.spaced:
                words = text.split(" ")
                words[1:] = [" " + w for w in words[1:]]
            ids = list(map(known.get, words))
            if None in ids:
                found = self._learn([w for w, i in zip(words, ids, strict=True) if i is None])
                ids = [found[w] if i is None else i for w, i in zip(words, ids, strict=True)]
            out.append(b"".join(ids))
        return out


def encoder(vocabulary: str) -> WordEncoder:
    """One per worker process, kept until another model is asked for."""
    return kept(("encoder", vocabulary), lambda: WordEncoder(vocabulary))
