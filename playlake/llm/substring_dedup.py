"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest.

A chunk may begin where the gear hash of the preceding ``WINDOW`` bytes is small, at the first byte
of a character, and does so if the next such place is at least ``SHORTEST`` bytes on. Both
rules look at nearby bytes only, so an insertion shifts no boundary but those beside it. With
``pieces`` a chunk of ``LONG`` bytes or more is cut again: text of a short period at its smallest rotation, other
text at local minima of the hash. Chunks tile a text; repeats that touch are joined, and spans of at least ``SPAN`` bytes are reported.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import slices, utf8
from .occurrences import FOUND, LONGEST, combined, cut_texts, digests, ids_or_last, keyed, places, repeats, spans

WINDOW = 16
ONE_IN = 10
SHORTEST = 10
SPAN = 128
SPAN_WORDS = 16  # or so many words: of 51 short ones more are left without the partial chunks at both ends
LONG = 96
PERIODS = 64
PERIODIC = 64  # bytes of a stretch that repeats itself with some period
STEP = 16
NEARBY = 32
PIECE = 1 << 20
ROWS_AT_ONCE = 2000

IS_BLANK = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r "))

#: The gear table: 16 bits of each byte value's hash.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 1) & 0xFFFF for b in range(256)], np.uint16)


def _gear(octets: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte: the sum over the last 16 bytes, each shifted by its age."""
    rolling, age = GEAR[octets], 1
    while age < WINDOW:
        rolling[age:] += rolling[:-age] << np.uint16(age)
        age *= 2
    return rolling


def boundaries(text: bytes) -> np.ndarray:
    """Where the chunks of a text begin: 0 and the accepted places, in order."""
    octets = np.frombuffer(text, np.uint8)
    if not len(octets):
        return np.empty(0, np.int64)
    found = []
    for start in range(WINDOW, len(octets), PIECE):
        stop = min(start + PIECE, len(octets))
        before = _gear(octets[start - WINDOW : stop - 1])[WINDOW - 1 :]  # the hash up to the byte before
        found.append(start + np.flatnonzero((before < 65536 // ONE_IN) & ((octets[start:stop] & 0xC0) != 0x80)))
    at = np.concatenate([np.empty(0, np.int64), *found])
    starts = np.concatenate(([0], at[np.diff(at, append=len(octets)) >= SHORTEST]))
    stops = np.append(starts[1:], len(octets))
    if (stops - starts).max() > LONGEST:  # places hold limited lengths
        starts = np.concatenate([np.arange(a, b, LONGEST) for a, b in zip(starts, stops, strict=True)])
    return starts


def _periodic_cuts(octets: np.ndarray) -> list[np.ndarray]:
    """Cuts inside the stretches of a period of at most ``PERIODS``, the shortest period first:
    from the first smallest rotation on, whole periods of at least ``STEP`` bytes apart."""
    found, free = [], np.ones(len(octets), bool)
    for period in range(1, min(PERIODS, len(octets) - 1) + 1):
        same = (octets[period:] == octets[:-period]) & free[period:] & free[:-period]
        edges = np.flatnonzero(np.diff(same, prepend=False, append=False)).reshape(-1, 2)
        for low, high in edges[edges[:, 1] - edges[:, 0] >= max(PERIODIC - period, period)].tolist():
            high += period
            twice = octets[low : low + 2 * period].tobytes()
            turns = [i for i in range(period) if twice[i] & 0xC0 != 0x80]  # at the first byte of a character
            if turns:
                turn = min(turns, key=lambda i: twice[i : i + period])
                found.append(np.arange(low + turn, high + 1, period * -(-STEP // period)))
                free[low:high] = False
    return found


def _hash_minima(octets: np.ndarray) -> np.ndarray:
    """Places whose gear hash is smaller than that of the ``NEARBY`` places on either side."""
    rolling = _gear(octets)[WINDOW - 1 :]  # the first is the hash before place WINDOW
    if len(rolling) <= 2 * NEARBY:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(rolling, NEARBY)
    least = windows.min(axis=1)
    middle = rolling[NEARBY:-NEARBY]
    smaller = (middle < least[: len(middle)]) & (middle < least[NEARBY + 1 :])
    at = WINDOW + NEARBY + np.flatnonzero(smaller)
    return at[(octets[at] & 0xC0) != 0x80]


def pieces(text: bytes) -> np.ndarray:
    """``boundaries``, and the cuts inside the chunks of ``LONG`` bytes or more."""
    starts = boundaries(text)
    lengths = np.diff(starts, append=len(text))
    octets, inner = np.frombuffer(text, np.uint8), []
    for at in np.flatnonzero(lengths >= LONG).tolist():
        start, chunk = starts[at], octets[starts[at] : starts[at] + lengths[at]]
        inner += [start + cuts for cuts in (*_periodic_cuts(chunk), _hash_minima(chunk))]
    if not inner:
        return starts
    cuts = np.unique(np.concatenate([starts, *inner]))
    return cuts[cuts < len(text)]


def _chunks(cut: Callable[[bytes], np.ndarray]):
    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            chunks, docs, keys, spots = [], [], [], []
            for doc, text, key in zip(ids_or_last(batch.column(0)), utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                starts = cut(text)
                if not len(starts):
                    continue
                stops = np.append(starts[1:], len(text))
                chunks += [text[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
                docs.append(np.full(len(starts), doc, np.int64))
                keys.append(np.full(len(starts), key, np.int64))
                spots.append(places(starts, stops - starts, _words_begun(text, starts)))
            if chunks:
                yield combined(*digests(chunks), *map(np.concatenate, (docs, keys, spots)))

    return step


def _words_begun(text: bytes, starts: np.ndarray) -> np.ndarray:
    """How many words begin in each chunk."""
    blank = IS_BLANK[np.frombuffer(text, np.uint8)]
    begins = ~blank & np.concatenate(([True], blank[:-1]))
    return np.add.reduceat(begins.astype(np.int64), starts)


def repeated_passages(
    docs: DataFrame, shortest: int = SPAN, cut: Callable[[bytes], np.ndarray] = boundaries, words: int | None = SPAN_WORDS
) -> DataFrame:
    """One row per repeated stretch: (doc_id, start, length, source_ids, text_key), in UTF-8 bytes.

    A stretch consists of whole chunks that occur earlier, by (doc_id, place), in any of the
    documents ``source_ids`` (the same document included), and is at least ``shortest`` bytes
    long or has ``words`` words. The first occurrence of a passage is not reported as a stretch, only as a source.
    Rows of one id, or without, and different texts are documents of their own, in the order of
    ``text_key``, a hash of the text; null ids come last. Rows that repeat an id and text count as one document. Empty texts have no chunks. ``cut`` says where the chunks of a text
    begin; with ``boundaries`` text of a period under ``SHORTEST`` is one chunk and its repeats
    are missed, ``pieces`` finds them.
    """
    found = keyed(docs).mapInArrow(_chunks(cut), FOUND)
    return spans(repeats(found), shortest, words)


def remove_passages(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs``, all columns, with the stretches ``found`` cut out of ``text``."""
    return cut_texts(docs, found, _without)


def _without(text, cuts):
    if text is None or cuts is None or not len(cuts):
        return text
    octets, kept, at = text.encode(), [], 0
    for cut in cuts:
        kept.append(octets[at : cut["start"]])
        at = max(at, cut["start"] + cut["length"])
    return b"".join([*kept, octets[at:]]).decode()
