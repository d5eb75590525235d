"""Encoding text into the pieces of a SentencePiece vocabulary, and decoding it back.

An Aho-Corasick automaton over all pieces reads a text once. At every position it follows
its output links through the pieces that end there, and each relaxes the best score of a
segmentation up to that point (Viterbi); back pointers give the ids. A character that no
piece covers falls back to its UTF-8 bytes at a price below every piece.

Scores: a unigram vocabulary brings log probabilities. The scores of a BPE vocabulary are
merge ranks, whose sum means nothing, so they are turned into log probabilities by Zipf's
law over the rank. With such a vocabulary the result is the most probable segmentation, not
the one its merges lead to; both decode to the same text.

Blanks are written as in the vocabulary: one is put in front of a text and all count, so
decoding gives exactly the text. A text is cut before each run of blanks, which no piece
crosses, and at line feeds, which no piece holds; each distinct part is segmented once.

A null or empty text has no ids and decodes to the empty text. Rows are independent:
repeated rows get equal results, null ids stay null, an empty table gives an empty result.
Lone surrogates cannot occur in Spark strings. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, slices, texts
from .wordcache import WordIds

#: How far below the worst piece a byte fallback lies.
FALLBACK_PENALTY = 10.0
#: Zipf-Mandelbrot offset of the rank.
ZIPF_OFFSET = 2.7
#: Characters of distinct units kept while a task runs, and bytes of text cut into units at once.
KEEP_CHARS, SLICE_BYTES = 3_000_000, 1 << 20
SCHEMA = "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean, ids array<int>"
_UNITS = re.compile(r" *[^ \n]+| +|\n")


class Pieces:
    """A vocabulary: ``normal`` (piece, id, score), ``byte_ids`` for fallback, bytes of every id."""

    def __init__(self, normal: list[tuple[str, int, float]], byte_ids: list[int], size: int):
        import ahocorasick

        self.table: list[bytes] = [b""] * size
        self.byte_ids = byte_ids
        for value, own in enumerate(byte_ids):
            self.table[own] = bytes([value])
        self.automaton = ahocorasick.Automaton()
        for piece, own, score in normal:
            plain = piece.replace("▁", " ")
            if "\n" in plain or re.search("[^ ] ", plain):
                raise ValueError(f"a piece crosses a cut: {piece!r}")
            self.table[own] = plain.encode()
            self.automaton.add_word(plain, (own, len(plain), score))
        self.automaton.make_automaton()
        self.fallback = min(score for *_, score in normal) - FALLBACK_PENALTY
        self.cache = WordIds(lambda units: [self.segment(u)[0] for u in units], keep=KEEP_CHARS)

    @classmethod
    def load(cls, path: str) -> "Pieces":
        import sentencepiece

        tool = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(len(tool))
        plain = [i for i in ids if not (tool.is_byte(i) or tool.is_control(i) or tool.is_unknown(i) or tool.is_unused(i))]
        scores = [tool.get_score(i) for i in plain]
        if all(s == int(s) for s in scores):  # merge ranks
            ranked = sorted(range(len(plain)), key=lambda k: (-scores[k], plain[k]))
            norm = math.log(sum(1 / (r + ZIPF_OFFSET) for r in range(len(plain))))
            for rank, k in enumerate(ranked):
                scores[k] = -math.log(rank + ZIPF_OFFSET) - norm
        byte_ids = {int(tool.id_to_piece(i)[1:-1], 16): i for i in ids if tool.is_byte(i)}
        normal = [(tool.id_to_piece(i), i, s) for i, s in zip(plain, scores)]
        return cls(normal, [byte_ids.get(b, tool.unk_id()) for b in range(256)], len(tool))

    def segment(self, unit: str) -> tuple[list[int], float]:
        """Best ids of a unit and their score."""
        n, fallback = len(unit), self.fallback
        best = [0.0] + [-math.inf] * n
        back: list[tuple[int, int]] = [(0, 0)] * (n + 1)  # (id or -1 for bytes, length)
        done = 0  # positions up to here are final

        for end, (own, length, score) in self.automaton.iter(unit):
            while done < end:
                if best[done] + fallback > best[done + 1]:
                    best[done + 1], back[done + 1] = best[done] + fallback, (-1, 1)
                done += 1
            reached = best[end + 1 - length] + score
            if reached > best[end + 1]:
                best[end + 1], back[end + 1] = reached, (own, length)
        while done < n:
            if best[done] + fallback > best[done + 1]:
                best[done + 1], back[done + 1] = best[done] + fallback, (-1, 1)
            done += 1
        ids, at = [], n
        while at:
            own, length = back[at]
            if own < 0:
                ids.extend(self.byte_ids[b] for b in reversed(unit[at - 1].encode()))
            else:
                ids.append(own)
            at -= length
        return ids[::-1], best[n]

    def units(self, text: str) -> list[str]:
        return _UNITS.findall(" " + text) if text else []

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        per_text = [self.units(t) for t in texts]
        counts = np.fromiter(map(len, per_text), np.int64, len(per_text))
        return self.cache.encode(pa.array([u for own in per_text for u in own], pa.large_string()), counts)

    def decode(self, ids) -> str:
        return b"".join(map(self.table.__getitem__, ids)).decode()[1:]


_kept: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """The worker's one instance for a file."""
    if path not in _kept:
        _kept[path] = Pieces.load(path)
    return _kept[path]


def _encode(batches: Iterator[pa.RecordBatch], path: str):
    tool = pieces_of(path)
    for batch in slices(batches, limit=SLICE_BYTES):
        own = texts(batch)
        ids, bounds = tool.encode_all(own)
        rows = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        same = [tool.decode(r.tolist()) == t for r, t in zip(rows, own)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(np.diff(bounds)),
                pa.array([zlib.crc32(r.astype("<u4")) for r in rows], pa.int64()),
                pa.array(same),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32))),
            ],
            names=["doc_id", "n_pieces", "ids_crc32", "round_trip", "ids"],
        )
    tool.cache.reset()  # an idle worker holds no more than the automaton


def encode(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: ids, their number and crc32, and whether decoding gave the text back."""
    return arrow_map(docs.select("doc_id", "text"), SCHEMA, _encode, path)


def _decode(batches: Iterator[pa.RecordBatch], path: str):
    tool = pieces_of(path)
    for batch in batches:
        decoded = [tool.decode(ids or []) for ids in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(decoded, pa.string())], names=["doc_id", "text"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with ids."""
    return arrow_map(encoded.select("doc_id", "ids"), "doc_id long, text string", _decode, path)
