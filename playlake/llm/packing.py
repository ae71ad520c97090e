"""Packing: vector bin packing of tokenised examples by the dot-product heuristic.

An example's vector is (tokens, one segment, loss-bearing tokens). A sequence takes, again and
again, the waiting example whose vector has the largest dot product with what is left of the
three limits, each as a share of its limit. Examples longer than a sequence are cut, and what
no waiting example fits is filled by cutting one. Every task packs the rows of its own scan
split, in one pass without a shuffle: tokens never travel, and what waits is bounded by
``WAITING`` examples. A task's last sequence is cut at powers of two, which need no padding.

Tokens come from a public vocabulary file; chunks between ASCII blanks are tokenised once
and remembered, which is exact because the tokenizer itself splits at white space.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import slices, utf8

END = 2
MAX_TOKENS = 4096
MAX_SEGMENTS = 256
MAX_LOSS = 4096
WAITING = 512
REMEMBERED = 500_000  # words, of up to ``SHORT`` bytes, so that what is remembered is bounded in bytes too
SHORT = 64
ROWS_AT_ONCE = 500

#: Letters, digits and signs for which the pre-tokenizer's pattern can be stated in bytes of
#: one code page; anything else goes through the whole tokenizer.
SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: Fixed value: the vocabulary's pre-tokenizer pattern over those characters, lower-cased.
PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The character a byte-level vocabulary writes for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTokenizer:
    """Ids of a text, word by word, as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        spelled = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
        ids = np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()
        if len(part) <= SHORT:
            if len(self.parts) >= REMEMBERED:
                self.parts.clear()
            self.parts[part] = ids
        return ids

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if "<|" not in text and SIMPLE.fullmatch(text):
            ids = b"".join([self.parts.get(p) or self._part(p) for p in PRETOKEN.findall(text.lower())])
        else:
            ids = np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= SHORT:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[word] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        known = self.words
        try:
            return b"".join([known[w] for w in text.split()])
        except KeyError:
            return b"".join([known[w] if w in known else self._word(w) for w in text.split()])


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The process's tokenizer of that file; its memory serves all tasks of a Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


@dataclass(slots=True)
class Example:
    """What is left of a document: its ids from ``start`` on."""

    doc_id: int | None
    ids: bytes  # of 32-bit ids, the whole document's
    start: int = 0


class Packer:
    """Packs a stream of examples, of which at most ``waiting`` wait; ``pieces`` collects
    (example, start, length, sequence, offset)."""

    def __init__(self, tokens: int, segments: int, loss: int, waiting: int = WAITING):
        if min(tokens, segments, loss) < 1:
            raise ValueError("limits must be positive")
        self.limits = np.array((tokens, segments, loss), np.int64)
        self.waiting = waiting
        self.pool: list[Example] = []
        self.vectors = np.empty((0, 3), np.int64)
        self.new: list[tuple[int, int, int]] = []
        self.pieces: list[tuple[Example, int, int, int, int]] = []
        self.sequence = 0

    def add(self, doc_id: int | None, ids: bytes, masked: int = 0) -> None:
        """A document whose first ``masked`` tokens bear no loss."""
        example, left = Example(doc_id, ids), len(ids) // 4
        masked = min(masked, left)
        if self.limits[2] >= self.limits[0]:
            while left >= self.limits[0]:  # whole sequences of one document
                self._close([(example, int(self.limits[0]))])
                left -= int(self.limits[0])
        if left:
            self.pool.append(example)
            self.new.append((left, 1, left - max(0, masked - example.start)))
        while len(self.pool) >= self.waiting:
            self._fill()

    def finish(self) -> None:
        while self.pool:
            self._fill()

    def _fill(self) -> None:
        """One sequence from the pool: the best fitting examples, then a cut one for the rest."""
        if self.new:
            self.vectors, self.new = np.concatenate((self.vectors, np.array(self.new, np.int64))), []
        vectors, left = self.vectors, self.limits.copy()
        shares = vectors / self.limits
        waits = np.ones(len(vectors), bool)
        chosen: list[tuple[int, int]] = []
        while left.min() > 0 and waits.any():
            fits = waits & (vectors <= left).all(axis=1)
            if fits.any():
                at = int(np.where(fits, shares @ (left / self.limits), -1.0).argmax())
                taken = vectors[at].copy()
            else:  # masked tokens come first in what is left of an example
                masked = vectors[:, 0] - vectors[:, 2]
                most = np.minimum(np.minimum(left[0], vectors[:, 0]), masked + left[2]) * waits
                at = int(most.argmax())
                if most[at] < 1:
                    break
                taken = np.array((most[at], 1, max(0, most[at] - masked[at])))
            waits[at] = False
            left -= taken
            chosen.append((at, int(taken[0])))
            vectors[at] -= (taken[0], 0, taken[2])
        self._close([(self.pool[at], length) for at, length in chosen])
        rest = vectors[:, 0] > 0
        self.pool = [e for e, some in zip(self.pool, rest.tolist(), strict=True) if some]
        self.vectors = vectors[rest]

    def _close(self, chosen: list[tuple[Example, int]]) -> None:
        """Emit a sequence; one that falls short becomes sequences of the powers of two in its length."""
        total = sum(length for _, length in chosen)
        if total == self.limits[0]:
            room = [total]
        else:
            room = [1 << bit for bit in range(total.bit_length() - 1, -1, -1) if total >> bit & 1]
        offset = 0
        for example, length in chosen:
            while length:
                part = min(length, room[0] - offset)
                self.pieces.append((example, example.start, part, self.sequence, offset))
                example.start += part
                length -= part
                offset += part
                if offset == room[0]:
                    room.pop(0)
                    self.sequence += 1
                    offset = 0


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _rows(pieces: list, first: int) -> pa.RecordBatch:
    columns = zip(
        *[
            (
                e.doc_id,
                start,
                length,
                zlib.crc32(memoryview(e.ids)[4 * start : 4 * (start + length)]),
                len(e.ids) // 4,
                first + sequence,
                offset,
            )
            for e, start, length, sequence, offset in pieces
        ],
        strict=True,
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in PIECES.split(", ")]
    )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = MAX_LOSS,
    masked: str | None = None,
) -> DataFrame:
    """One row per piece of a document: (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset).

    A document is the ids of its text followed by ``END``; a null or empty text is ``END``
    alone. Every id lies in exactly one piece; the pieces of a sequence fill it from offset
    0 without gaps, within ``max_tokens`` tokens, ``max_segments`` pieces and ``max_loss``
    loss-bearing tokens. ``masked`` names a column with the number of leading tokens that bear
    no loss, as a prompt's (null: none); without it every token bears loss. Repeated ids are
    packed as the separate rows they are.
    """
    prompt = F.coalesce(F.col(masked).cast("bigint"), F.lit(0)) if masked else F.lit(0).cast("bigint")
    columns = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        prompt.alias("masked"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(tokenizer_path)
        packer = Packer(max_tokens, max_segments, max_loss)
        first = TaskContext.get().partitionId() << 40
        end = np.array([END], "<u4").tobytes()
        for batch in slices(batches, ROWS_AT_ONCE):
            for doc_id, text, skip in zip(
                batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True
            ):
                packer.add(doc_id, words.ids(text) + end, max(0, skip))
            if packer.pieces:
                yield _rows(packer.pieces, first)
                packer.pieces = []
        packer.finish()
        if packer.pieces:
            yield _rows(packer.pieces, first)

    return columns.mapInArrow(run, PIECES)
