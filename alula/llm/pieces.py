"""SentencePiece models applied with an Aho-Corasick automaton and a single-pass Viterbi search.

All normal pieces of a model form one automaton. Scanning a text once, the automaton reports at every position the pieces
that end there, the longest first and then, along its output links, the shorter ones; each relaxes the best score of its end.
Characters that no piece covers fall back to their UTF-8 bytes, at ten below the lowest score. Following the best
predecessors back gives the segmentation with the highest sum of scores (ties: the longest last piece).

A blank is written U+2581 and one is put before the text. Where a model's pieces never continue over a blank (checked
when it is loaded), words are independent and a worker remembers the segmentations of a bounded number of them. A
literal U+2581 is encoded as bytes, so that decoding gives every text back exactly.

Null and empty texts have no ids and decode to the empty text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alula.llm.common import Remembered, extended, own_caches, slices, with_text

BLANK = "▁"
#: Words a worker remembers are at most twice these;  the characters taken from a text at a time.
WORD_CACHE, SPAN = 500_000, 1 << 20


class PieceModel:
    """A segmenter made from the bytes of a SentencePiece model."""

    def __init__(self, proto: bytes):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=proto)
        size = sp.get_piece_size()
        self.scores = {
            sp.id_to_piece(i): (i, sp.get_score(i)) for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        }
        self.byte_ids = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.table = [b""] * size
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.table[i] = bytes([int(piece[1:-1], 16)])
            elif piece in self.scores:
                self.table[i] = piece.replace(BLANK, " ").encode()
        self.fallback = min((s for _, s in self.scores.values()), default=0.0) - 10.0
        self.automaton = ahocorasick.Automaton()
        for piece, (i, score) in self.scores.items():
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.single = {p for p in self.scores if len(p) == 1}
        self.by_word = not any(re.search(f"[^{BLANK}]{BLANK}|\n", p) for p in self.scores)
        self.words, self.lines = _Words(self, True), _Words(self, False)

    def _spelled(self, char: str) -> list[int]:
        return [self.byte_ids.get(b, self.unknown) for b in char.encode("utf-8", "surrogatepass")]

    def segment(self, marked: str) -> list[int]:
        """Ids of a text in which blanks are already marked."""
        n = len(marked)
        best = [0.0] + [float("-inf")] * n
        back: list = [None] * (n + 1)
        single, fallback, at = self.single, self.fallback, 0
        for end, (length, score, piece) in self.automaton.iter(marked):
            while at <= end:
                if marked[at] not in single and best[at] + fallback > best[at + 1]:
                    best[at + 1], back[at + 1] = best[at] + fallback, (1, -1)
                at += 1
            reached = best[end + 1 - length] + score
            if reached > best[end + 1]:
                best[end + 1], back[end + 1] = reached, (length, piece)
        while at < n:
            if marked[at] not in single and best[at] + fallback > best[at + 1]:
                best[at + 1], back[at + 1] = best[at] + fallback, (1, -1)
            at += 1
        out: list[list[int]] = []
        while n:
            length, piece = back[n]
            out.append([piece] if piece >= 0 else self._spelled(marked[n - 1]))
            n -= length
        return [i for ids in reversed(out) for i in ids]

    def _part(self, text: str, first: bool) -> list[int]:
        """Ids of a piece of text; ``first``: a marked blank goes before it. Literal U+2581 are spelled as bytes."""
        marked = ((" " if first else "") + text).split(BLANK)
        out = self.segment(marked[0].replace(" ", BLANK))
        for rest in marked[1:]:
            out += self._spelled(BLANK) + self.segment(rest.replace(" ", BLANK))
        return out

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.int32)
        if not self.by_word:
            return np.array(self._part(text, True), dtype=np.int32)
        parts, at = [], 0
        while at <= len(text):
            stop = text.find(" ", at + SPAN)
            while stop > 0 and text[stop - 1] == " ":
                stop = text.find(" ", stop + 1)
            part = text[at:] if stop < 0 else text[at:stop]
            if "  " in part or part[:1] == " ":
                words = [u[1:] for u in re.findall(" +[^ ]*", " " + part)]
            else:
                words = part.split(" ")
            parts.append(b"".join(map(self.words.__getitem__, words)))
            at = len(text) + 1 if stop < 0 else stop + 1
        return np.frombuffer(b"".join(parts), dtype=np.int32)

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.table.__getitem__, ids.tolist()))
        return raw[1:].decode("utf-8", "replace")


class _Words(Remembered):
    """Word -> its ids as bytes of 32-bit integers. ``first``: a blank goes before the word (its key may start with more),
    else a line break. Words with line breaks are put together from their lines: no piece has a line break."""

    def __init__(self, model: PieceModel, first: bool):
        super().__init__(self.ids, WORD_CACHE, "pieces")
        self.model, self.first = model, first

    def ids(self, word: str) -> bytes:
        ids = self.model._part(word, self.first)
        return np.array(ids if self.first else self.model._spelled("\n") + ids, dtype=np.int32).tobytes()

    def __missing__(self, word: str) -> bytes:
        if self.first and "\n" in word:
            start, *lines = word.split("\n")
            return b"".join([self[start], *map(self.model.lines.__getitem__, lines)])
        return super().__missing__(word) if len(word) < 200 else self.ids(word)


@lru_cache(maxsize=2)
def load_model(proto: bytes) -> PieceModel:
    return PieceModel(proto)


def encode_pieces(docs: DataFrame, model_path: str, keep: list[str], check: bool = True) -> DataFrame:
    """``keep`` columns with ``__pieces`` (ids) of every row's text and ``__round_trip``: decoding gives the text back.

    The driver reads the model file; its bytes (a fixed vocabulary) are broadcast."""
    with open(model_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    names = list(keep)
    rows, text = with_text(docs, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_caches("pieces")
        model = load_model(shared.value)
        for batch in slices(batches, 64):
            texts = batch.column(text).to_pylist()
            ids = [model.encode(t) for t in texts]
            same = [model.decode(i) == (t or "") for i, t in zip(ids, texts)] if check else [None] * len(texts)
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else [], pa.int32()))
            crcs = [zlib.crc32(i.astype("<u4").tobytes()) & 0xFFFFFFFF for i in ids]
            columns = [batch.column(c) for c in names] + [lists, pa.array(crcs, pa.int64()), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "__pieces", "__crc32", "__round_trip"])

    schema = extended(docs.select(*names).schema, "__pieces array<int>, __crc32 long, __round_trip boolean")
    return rows.mapInArrow(run, schema)


def decode_pieces(encoded: DataFrame, model_path: str, pieces: str, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``__text`` decoded from the id lists in ``pieces``; null lists give the empty text."""
    with open(model_path, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(shared.value)
        for batch in slices(batches):
            texts = [model.decode(np.array(i if i is not None else [], dtype=np.int32)) for i in batch.column("__ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(texts, pa.string())], [*names, "__text"])

    schema = extended(encoded.select(*names).schema, "__text string")
    return encoded.select(*names, F.col(pieces).alias("__ids")).mapInArrow(run, schema)
