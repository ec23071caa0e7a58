"""Tables for `TextIds.java`: ids of whole texts by a byte-level tokenizer, outside of Python.

For byte-pair tokenizers that cut words by GPT-2's pattern and change nothing before. Letters,
numbers and white space are those of the tokenizers library itself, which is asked for every code
point; that texts get the same ids as from the library is tested.

Tables, as 32-bit integers: the end id, an id per byte, the number of mergers, each with two ids
and the id made of them, in order of rank; the number of runs of code points, each with the first
and its kind (0 others, 1 letters, 2 numbers, 3 white space).
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from tickloom.llm.word_ids import BYTE_CHARS

CHANGES = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")


def _kinds(cut) -> list[int]:
    """Runs of code points of one kind by the library's `cut` of a text into words."""
    out = []
    for first, last in ((0, 32), (32, 33), (33, 0xD800), (0xE000, 0x110000)):
        text = "".join(map(chr, range(first, last)))
        for _, (at, _) in cut(text):
            char = text[at]
            kind = next((k for k, before in ((1, "a"), (2, "0"), (0, "!")) if len(cut(before + char)) == 1), 3)
            out += [first + at, 3 if char == " " else kind]
    return out


@lru_cache(maxsize=4)
def tables(data: str, end_id: int) -> bytes | None:
    """The tables of a tokenizer's JSON text; none if it works in another way."""
    made = json.loads(data)
    model, cut = made["model"], made.get("pre_tokenizer") or {}
    chars = [chr(BYTE_CHARS.get(b, b)) for b in range(256)]
    if (model.get("type") != "BPE" or any(model.get(k) for k in CHANGES) or any(c not in model["vocab"] for c in chars)
            or any(made.get(k) is not None for k in ("normalizer", "truncation", "padding"))
            or (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) != ("ByteLevel", False, True)
            or not all(t["special"] for t in made.get("added_tokens") or ())):
        return None
    from tokenizers import Tokenizer

    vocab, runs = model["vocab"], _kinds(Tokenizer.from_str(data).pre_tokenizer.pre_tokenize_str)
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if len(set(map(tuple, pairs))) < len(pairs):
        return None
    return np.array([end_id, *(vocab[c] for c in chars), len(pairs),
                     *(x for a, b in pairs for x in (vocab[a], vocab[b], vocab[a + b])),
                     len(runs) // 2, *runs], "<i4").tobytes()
