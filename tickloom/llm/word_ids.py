"""Token ids of whole texts, with the tokenizers library called once per distinct word part.

For byte-level tokenizers whose normalizer and pre-tokenizer never look across white space, as
those do that turn `\\s+` into one space, lower their letters and match runs of letters, single
digits and runs of signs. A text's ids are then the ids of its words one after the other. A
word is cut further into the ASCII digits and signs around it and its core, where the core
begins and ends with a letter below U+0250 (U+0130 aside, whose lower case ends with a sign):
no match of letters goes on into those, nothing is composed with them, and an apostrophe, which
may start a match with letters, always stays in the core. Cores of letters below U+0250 are one
match and go straight to the library's model, every other part through the whole library.

What the library returns for words and parts is kept for the texts to come, for `CACHE` of each
or a batch more; then it is forgotten.
"""

from __future__ import annotations

import os
import re

import numpy as np

from tickloom.llm.common import Numbers

CACHE = 500_000
LETTER = "[A-Za-zÀ-ÖØ-öø-įı-ɏ]"
SIGNS = r"([!-&(-@\[-`{-~]*)"           # ASCII digits and signs without the apostrophe
PLAIN = re.compile(rf"{SIGNS}({LETTER}(?:[!-ɏ]*{LETTER})?){SIGNS}")
#: Bytes as the characters that byte-level vocabularies use for them.
BYTE_CHARS = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}


class _Ragged:
    """Arrays of ids one after the other, by number."""

    def __init__(self):
        self.flat, self.starts = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered arrays in a row, and the length of each."""
        first = self.starts[numbers]
        lengths = self.starts[numbers + 1] - first
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(first - (ends - lengths), lengths) + np.arange(total)], lengths


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of `counts` values each, in order."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


class WordIds:
    """Ids of texts as unsigned 32-bit integers by the JSON text of a tokenizer."""

    def __init__(self, data: str, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_str(data)
        self.coder.encode_special_tokens = True     # their strings in a text are ordinary text
        self.model, self.cache = self.coder.model, cache
        self.words, self.parts = Numbers(), Numbers()
        self.word_ids, self.part_ids = _Ragged(), _Ragged()

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        if len(self.words) > self.cache:
            self.words, self.word_ids = Numbers(), _Ragged()
        if len(self.parts) > self.cache:
            self.parts, self.part_ids = Numbers(), _Ragged()
        look_up = self.words.__getitem__
        split = [(text or b"").split() for text in texts]       # ASCII white space only
        numbers = [np.fromiter(map(look_up, words), np.int64, len(words)) for words in split]
        if self.words.new:
            self._learn(self.words.taken())
        counts = np.array([len(x) for x in numbers], np.int64)
        ids, lengths = self.word_ids.take(np.concatenate([np.zeros(0, np.int64), *numbers]))
        return np.split(ids, np.cumsum(_sums(lengths, counts))[:-1]) if texts else []

    def _learn(self, words: list[bytes]) -> None:
        number, numbers, counts = self.parts.__getitem__, [], []
        for word in words:
            if word.isalpha():
                numbers.append(number(word.lower().decode()))
                counts.append(1)
                continue
            found = PLAIN.fullmatch(text := word.decode())
            cut = [p for p in found.groups() if p] if found else [text]
            numbers += map(number, cut)
            counts.append(len(cut))
        if self.parts.new:
            self._encode_parts(self.parts.taken())
        ids, lengths = self.part_ids.take(np.array(numbers, np.int64))
        self.word_ids.add(ids, _sums(lengths, np.array(counts, np.int64)))

    def _encode_parts(self, parts: list[str]) -> None:
        made, others = [None] * len(parts), []
        for i, part in enumerate(parts):
            if part.isalpha() and max(part) < "ɐ" and (low := part.lower()).isalpha():
                if not low.isascii():
                    low = low.encode().decode("latin-1").translate(BYTE_CHARS)
                made[i] = [token.id for token in self.model.tokenize(low)]
            else:
                others.append(i)
        for i, found in zip(others, self.coder.encode_batch_fast([parts[i] for i in others], add_special_tokens=False)):
            made[i] = found.ids
        lengths = np.fromiter(map(len, made), np.int64, len(made))
        self.part_ids.add(np.fromiter((i for ids in made for i in ids), "<u4", int(lengths.sum())), lengths)
