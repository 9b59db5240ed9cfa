"""Token ids of texts, by the tokenizers library.

The vocabulary's pre-tokenizer never joins characters across white space, and a run of Latin letters
followed by plain punctuation always ends a piece. So a word is encoded once for many texts:
words are dealt out by Arrow, the ids of each different word come from the tokenizer, and ids of texts are
gathered with numpy. Texts that hold a special token's text go through the whole tokenizer.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import worker_memory
from .words import ranges

# Words made of these two parts end a piece between them.
PLAIN = r"^[a-z\x{DF}-\x{F6}\x{F8}-\x{FF}]+"
TAIL = r"[.,*$%#&|;:!?\")(]"
KEPT_WORDS = 300_000  # words a worker remembers, about 200 bytes each


def _byte_letters() -> dict[int, int]:
    """The printable stand-in of each byte in byte-level vocabularies, by their usual rule."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of texts with one tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.small = self.whole.get_vocab_size() <= 65536
        self._forget()

    def _forget(self) -> None:
        """Ids of known words lie one after another; word 0 is empty."""
        self.known: dict[str, int] = {"": 0}
        self.ids, self.ends = array("I"), array("q", [0])

    def of_text(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def _letters(self, word: str) -> list[int]:
        """Ids of lower-case Latin letters, which are one piece."""
        piece = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(piece)]

    def _numbers(self, words: pa.Array, encode) -> np.ndarray:
        """The number under which each word's ids are known, after encoding new words."""
        deal = words.dictionary_encode()
        known, ids, ends = self.known, self.ids, self.ends
        numbers = []
        for w in deal.dictionary.to_pylist():
            n = known.get(w)
            if n is None:
                ids.extend(encode(w))
                n = known[w] = len(ends)
                ends.append(len(ids))
            numbers.append(n)
        return np.array(numbers, np.int64)[deal.indices.to_numpy()]

    def _parts(self, words: pa.Array) -> np.ndarray:
        """Two numbers for each word: letters, and the punctuation behind them where both are exact alone."""
        out = np.zeros((len(words), 2), np.int64)
        plain = pc.match_substring_regex(words, PLAIN + TAIL + "*$")
        at = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
        chosen = words.filter(plain)
        out[at, 0] = self._numbers(pc.replace_substring_regex(chosen, TAIL + "+$", ""), self._letters)
        out[at, 1] = self._numbers(pc.replace_substring_regex(chosen, PLAIN, ""), self.of_text)
        at = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        out[at, 0] = self._numbers(words.filter(pc.invert(plain)), self.of_text)
        return out

    def of_texts(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another (each followed by `end`), and the n + 1 marks between them."""
        texts = pc.fill_null(texts, "")
        special = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False))
        if len(special):
            return self._piecewise(texts, special, end)
        if len(self.known) > KEPT_WORDS:
            self._forget()
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        deal = split.flatten().dictionary_encode()
        per_text = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        parts = self._parts(deal.dictionary)
        ends = np.array(self.ends)
        start, size = ends[parts - 1], ends[parts] - ends[parts - 1]
        start[parts == 0] = size[parts == 0] = 0
        which = deal.indices.to_numpy()
        lengths = np.concatenate(([0], np.cumsum(size.sum(axis=1)[which])))
        marks = lengths[np.concatenate(([0], np.cumsum(per_text)))]
        ids = np.array(self.ids, np.uint32)[ranges(start[which].ravel(), size[which].ravel())]
        if end is None:
            return ids, marks
        marks = marks + np.arange(len(marks))
        out = np.full(marks[-1], end, np.uint32)
        keep = np.ones(marks[-1], bool)
        keep[marks[1:] - 1] = False
        out[keep] = ids
        return out, marks

    def _piecewise(self, texts: pa.Array, special: np.ndarray, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        parts, sizes, at = [], [], 0
        tail = np.zeros(0, np.uint32) if end is None else np.array([end], np.uint32)
        for i in [*special.tolist(), len(texts)]:
            if i > at:
                ids, marks = self.of_texts(texts.slice(at, i - at), end)
                parts.append(ids)
                sizes.extend(np.diff(marks).tolist())
            if i < len(texts):
                one = np.concatenate((np.array(self.of_text(texts[i].as_py()), np.uint32), tail))
                parts.append(one)
                sizes.append(len(one))
            at = i + 1
        return np.concatenate(parts), np.concatenate(([0], np.cumsum(np.array(sizes, np.int64))))


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    return worker_memory("encoder:" + path, lambda: WordEncoder(path))
