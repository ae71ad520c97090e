"""Line dedup: winnowing over line hashes, matches extended both ways, later runs deleted.

A line is a fingerprint if its hash is the smallest, the last of equals, in some window of
``RUN`` lines. A run of ``RUN`` lines that stands in two places has the same fingerprint in
both, so every repeat is found. Fingerprints are joined by hash; each one that occurs twice
is extended both ways to all runs of ``RUN`` lines that hold it, those are joined in turn, and
whatever run occurred earlier is deleted; touching runs make longer ones.

Runs of fewer lines are windows of their own, each its own minimum: of ``WORDS`` words or more they
are found as well, and so is a document of fewer than ``RUN`` lines that stands earlier as a whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, utf8
from .occurrences import FOUND, SILENT, combined, cut_texts, digests, ids_or_last, keyed, places, repeats, spans

RUN = 3
WORDS = 50  # shorter runs are findings from so many words on
BLANKS = b" \t\x0b\x0c\r"
ROWS_AT_ONCE = 5000


def lines_of(text: bytes) -> list[bytes]:
    """The lines that count: without blanks at either end, empty ones left out."""
    return [line for raw in text.split(b"\n") if (line := raw.strip(BLANKS))]


def fingerprints(hashes: np.ndarray, run: int = RUN) -> np.ndarray:
    """Places of the window minima; a window's last smallest hash is selected."""
    if len(hashes) < run:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, run)
    last = run - 1 - windows[:, ::-1].argmin(axis=1)
    return np.unique(np.arange(len(windows)) + last)


def _line_digests(lines: list[bytes]) -> np.ndarray:
    """128-bit digests of the lines, as two columns of 64 bits."""
    return np.column_stack(digests(lines)) if lines else np.empty((0, 2), np.int64)


def _fingerprint_rows(run: int):
    """Documents -> (hash, doc, key, at, low, known, around): a fingerprint and the digests of the
    lines up to ``run - 1`` before and after it. ``known``: it occurs again in the same batch."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            found = []
            for doc, text, key in zip(ids_or_last(batch.column(0)), utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                lines = _line_digests(lines_of(text))
                for at in fingerprints(lines[:, 0], run).tolist():
                    low = max(0, at - run + 1)
                    found.append((int(lines[at, 0]), doc, key, at, low, lines[low : at + run].ravel().tolist()))
            if not found:
                continue
            found.sort(key=lambda f: f[:4])
            columns = list(zip(*found, strict=True))
            hashes = np.array(columns[0], np.int64)
            alone = np.concatenate(([True], hashes[1:] != hashes[:-1]))
            again = np.concatenate((~alone[1:], [False])) | ~alone
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(alone, hashes, hashes ^ np.array(columns[1]) * 0x5851F42D4C957F2D)),
                    *[pa.array(c, pa.int64()) for c in columns[1:5]],
                    pa.array(np.where(alone, np.where(again, 1, 0), 2), pa.int64()),
                    pa.array(columns[5], pa.list_(pa.int64())),
                ],
                names=["hash", "doc", "key", "at", "low", "known", "around"],
            )

    return step


def _window_rows(run: int):
    """Fingerprints by hash -> the runs of ``run`` lines around each one that occurs again."""

    def runs(doc: int, key: int, at: int, low: int, around: list[int]) -> Iterator[tuple[bytes, int, int, int]]:
        lines = np.array(around, np.int64).reshape(-1, 2)
        for start in range(low, min(at, low + len(lines) - run) + 1):
            yield lines[start - low : start - low + run].tobytes(), doc, key, start

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the first fingerprint of a hash, until another one comes
        for batch in batches:
            out = []
            for hashed, *place, known, around in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = (*place, around)
                if known == 2:
                    out.extend(runs(*row))
                    continue
                if held and held[0] == hashed:
                    if held[1]:
                        out.extend(runs(*held[1]))
                    out.extend(runs(*row))
                    held = (hashed, None)
                elif known:
                    out.extend(runs(*row))
                    held = (hashed, None)
                else:
                    held = (hashed, row)
            if out:
                yield _occurrences(out, run)

    return step


def _occurrences(units: list[tuple[bytes, int, int, int]], length: int | np.ndarray) -> pa.RecordBatch:
    """Units (bytes, doc, key, start) of ``length`` lines as open and known occurrences."""
    values, doc, key, start = zip(*units, strict=True)
    starts = np.array(start, np.int64)
    spots = places(starts, np.broadcast_to(length, starts.shape))
    return combined(*digests(values), np.array(doc, np.int64), np.array(key, np.int64), spots)


def _short_rows(run: int, words: int):
    """Documents -> occurrences of their runs of fewer than ``run`` lines. Those of ``words`` words or more, and
    the whole of a document of so few lines, are findings if they stand earlier; others are
    sources only."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            units, lengths = [], []
            for doc, text, key in zip(ids_or_last(batch.column(0)), utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                lines = lines_of(text)
                held, marks = [len(line.split()) for line in lines], _line_digests(lines)
                for size in range(1, run):
                    for start in range(len(lines) - size + 1):
                        told = size == len(lines) or sum(held[start : start + size]) >= words
                        units.append((marks[start : start + size].tobytes(), doc, key, start))
                        lengths.append(size if told else size | SILENT)
            if units:
                yield _occurrences(units, np.array(lengths, np.int64))

    return step


def repeated_runs(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """One row per repeated run: (doc_id, start, length, source_ids, text_key), counted in lines.

    Lines end at a line feed, count without blanks at either end, and not at all if empty. A
    line is in a run if it lies among lines that stand, the same and in the same order, earlier:
    ``run`` lines in a row; fewer in a row, of ``words`` words or more together; or all lines of a
    document that has fewer than ``run``. Earlier is in a document of smaller id or further up in
    the same one, both listed in ``source_ids``. Rows of one id, or without, and different texts are
    documents of their own, in the order of ``text_key``, a hash of the text; null ids come last. Rows that
    repeat an id and text count as one document.
    """
    rows = keyed(docs)
    marked = rows.mapInArrow(
        _fingerprint_rows(run), "hash long, doc long, key long, at long, low long, known long, around array<bigint>"
    )
    dealt = marked.repartition("hash").sortWithinPartitions("hash", F.desc("known"), "doc", "key", "at")
    found = dealt.mapInArrow(_window_rows(run), FOUND)
    if run > 1:
        found = found.unionByName(rows.mapInArrow(_short_rows(run, words), FOUND))
    return spans(repeats(found), 1)


def remove_runs(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs``, all columns, with the runs ``found`` deleted from ``text``; empty lines stay."""
    return cut_texts(docs, found, _without)


def _without(text, cuts):
    if text is None or cuts is None or not len(cuts):
        return text
    gone = {i for cut in cuts for i in range(cut["start"], cut["start"] + cut["length"])}
    kept, number = [], 0
    for raw in text.encode().split(b"\n"):
        if raw.strip(BLANKS):
            if number not in gone:
                kept.append(raw)
            number += 1
        else:
            kept.append(raw)
    return b"\n".join(kept).decode()
