"""Encoding whole texts by way of their distinct words.

A tokenizer never joins anything across the places where a text is cut into units here,
so a unit's ids depend on nothing else. A slice of texts is dictionary-encoded by Arrow,
its distinct units are looked up among those the worker has kept, and only new ones are
encoded. What is kept is bounded; after that it starts anew.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of distinct units one worker keeps; with their ids about 150 MB.
KEEP_CHARS = 8_000_000


class WordIds:
    """``encode_units`` maps distinct units to their id lists; ``parts`` may cut a unit in two."""

    def __init__(self, encode_units: Callable, parts: Callable | None = None, keep: int = KEEP_CHARS):
        self.encode_units, self.parts, self.keep = encode_units, parts, keep
        self.reset()

    def reset(self) -> None:
        self.slots: dict[str, int] = {}
        self.chars = 0
        self.pool, self.n_ids = np.empty(1 << 20, np.uint32), 0
        self.first, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, new: list[str]) -> None:
        found = self.encode_units(new)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ends = self.n_ids + np.cumsum(lengths)
        if ends[-1] > len(self.pool):
            self.pool = np.resize(self.pool, int(ends[-1]) * 2)
        self.pool[self.n_ids : ends[-1]] = np.fromiter((i for ids in found for i in ids), np.uint32)
        self.slots.update(zip(new, range(len(self.first), len(self.first) + len(new))))
        self.first = np.concatenate((self.first, ends - lengths))
        self.length = np.concatenate((self.length, lengths))
        self.n_ids = int(ends[-1])
        self.chars += sum(map(len, new))

    def _gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.length[slots]
        ends = np.cumsum(lengths)
        places = np.repeat(self.first[slots] - ends + lengths, lengths)
        places += np.arange(len(places))
        return self.pool[places], ends

    def encode(self, units: pa.Array, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's ids begin (one bound more)."""
        if self.chars > self.keep:
            self.reset()
        coded = pc.dictionary_encode(units)
        distinct = coded.dictionary.to_pylist()
        halves = [self.parts(u) for u in distinct] if self.parts else [(u, "") for u in distinct]
        heads, tails = zip(*halves) if halves else ((), ())
        wanted = dict.fromkeys(heads)
        wanted.update(dict.fromkeys(tails))
        if new := [u for u in wanted if u not in self.slots]:
            self._learn(new)
        head, tail = (
            np.fromiter(map(self.slots.__getitem__, x), np.int64, len(x)) for x in (heads, tails)
        )
        codes = coded.indices.to_numpy(zero_copy_only=False)
        slots = np.column_stack((head, tail))[codes].ravel() if self.parts else head[codes]
        ids, ends = self._gather(slots)
        ends = np.concatenate(([0], ends))
        return ids, ends[np.concatenate(([0], np.cumsum(per_text))) * (2 if self.parts else 1)]


#: Marks that, after letters, are a pre-token of their own.
_MARKS = ".,!?#*$%&:;"


def _word_and_marks(unit: str) -> tuple[str, str]:
    word = unit.rstrip(_MARKS)
    # a letter may become a letter and an accent in lower case, which joins the marks behind it
    return (word, unit[len(word) :]) if word != unit and word.isalpha() and word.lower().isalpha() else (unit, "")


def _byte_alphabet() -> dict[int, int]:
    """Bytes that the byte-level pre-tokenizer writes as other characters, by its public rule."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in kept]
    return {b: 256 + n for n, b in enumerate(others)}


class TextTokenizer:
    """A tokenizer file whose pre-tokenizer drops white space and keeps letters, digits and marks apart.

    Texts are cut at blank, tab, line feed and carriage return and ASCII letters are lower-cased
    if the file's normalizer does so anyway; every other rule stays with the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tool = Tokenizer.from_file(path)
        self.size = tool.get_vocab_size()
        self.lower = '"Lowercase"' in str(tool.normalizer.__getstate__())
        model, alphabet = tool.model, _byte_alphabet()
        plain = self.lower and '"ByteLevel"' in str(tool.pre_tokenizer.__getstate__())

        def encode(units: list[str]) -> list[list[int]]:
            out: list = [None] * len(units)
            rest = []
            for k, u in enumerate(units):
                if plain and u.isalpha() and u.islower() and u.lower() == u and is_normalized("NFC", u):
                    # one pre-token, which the normalizer leaves as it is
                    own = u if u.isascii() else u.encode().decode("latin-1").translate(alphabet)
                    out[k] = [t.id for t in model.tokenize(own)]
                else:
                    rest.append(k)
            for k, e in zip(rest, tool.encode_batch_fast([units[k] for k in rest], add_special_tokens=False)):
                out[k] = e.ids
            return out

        self.words = WordIds(encode, _word_and_marks if self.lower else None)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # a slice keeps its parent's buffers, and the string kernels misplace the offsets of some slices
        texts = texts.take(pa.array(np.arange(len(texts))))
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.lower and not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        for blank in "\t\n\r":
            texts = pc.replace_substring(texts, blank, " ")
        split = pc.split_pattern(texts, " ")
        return self.words.encode(split.flatten(), pc.list_value_length(split).to_numpy(zero_copy_only=False))


_kept: dict[str, TextTokenizer] = {}


def text_tokenizer(path: str) -> TextTokenizer:
    """The worker's one instance for a file."""
    if path not in _kept:
        _kept[path] = TextTokenizer(path)
    return _kept[path]
