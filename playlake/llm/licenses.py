"""License scan: exact phrases, and short notices within a few edits by pigeonhole seeds.

A notice searched with at most ``k`` edits is split into ``k + 1`` seeds; whatever matches
within ``k`` edits holds one seed unchanged. One automaton finds all seeds of all notices in a
text; around each hit the ``regex`` library's bounded-error matching looks for the notice in a
window just large enough, and reports span and edits; what is left of the window on either side
of a best match is searched in turn. One scan of the documents, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import id_and_text, slices, utf8

ROWS_AT_ONCE = 500

#: The exact phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Short notices in normalised words, their label, and the edits allowed.
NOTICES = (
    ("the mit license", "mit", 1),
    ("apache license", "apache", 1),
    ("released under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("spdx license identifier mit", "mit", 2),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("spdx license identifier apache 2 0", "apache", 2),
    ("gnu general public license", "gpl", 3),
    ("either version 3 of the license or at your option any later version", "gpl", 5),
    ("gnu lesser general public license", "lgpl", 3),
    ("gnu affero general public license", "agpl", 3),
    ("redistribution and use in source and binary forms with or without modification", "bsd", 6),
    ("mozilla public license", "mpl", 2),
    ("licensed under cc by nc 4 0", "cc-by-nc", 1),
    ("licensed under cc by sa 4 0", "cc-by-sa", 1),
    ("licensed under cc by 4 0", "cc-by", 1),
    ("creative commons attribution", "cc", 2),
)

#: Bytes that belong to a word, A-Z lower-cased; every other byte becomes a space.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def seeds(notice: str, edits: int) -> list[tuple[int, str]]:
    """The notice cut into ``edits + 1`` pieces of near equal length, with their places."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    """Finds phrases and notices in normalised text: words joined by single spaces."""

    def __init__(self, notices=NOTICES, phrases=PHRASES):
        import ahocorasick

        self.notices, self.phrases = notices, phrases
        self.exact = [
            (regex.compile(rb"(?<![^ ])(?=" + p.encode() + rb"(?![^ ]))"), label) for p, label in phrases.items()
        ]
        self.fuzzy = [
            regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(n)}){{e<={edits}}}(?![^ ])") for n, _, edits in notices
        ]
        by_seed: dict[str, list[tuple[int, int]]] = {}
        for number, (notice, _, edits) in enumerate(notices):
            for place, seed in seeds(notice, edits):
                by_seed.setdefault(seed, []).append((number, place))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in by_seed.items():
            self.automaton.add_word(seed, (len(seed), uses))
        self.automaton.make_automaton()

    def exact_places(self, plain: bytes) -> list[tuple[int, str]]:
        """(word number, label) of every place where a phrase's words stand in a row."""
        found = [(m.start(), label) for pattern, label in self.exact for m in pattern.finditer(plain)]
        places, number, last = [], 0, 0
        for at, label in sorted(found):
            number, last = number + plain.count(b" ", last, at), at
            places.append((number, label))
        return places

    def spans(self, plain: str) -> list[tuple[str, int, int, int, float]]:
        """(label, start, end, edits, likeness) of the best matches in every candidate window, none
        of a notice overlapping."""
        windows: dict[int, list[list[int]]] = {}
        for end, (size, uses) in self.automaton.iter(plain):
            for number, place in uses:
                notice, _, edits = self.notices[number]
                start = end + 1 - size - place
                near = [max(0, start - edits), min(len(plain), start + len(notice) + edits)]
                # A window is widened to whole words, as matches begin and end at their bounds.
                near[0] = plain.rfind(" ", 0, near[0] + 1) + 1
                stop = plain.find(" ", near[1])
                near[1] = len(plain) if stop < 0 else stop
                windows.setdefault(number, []).append(near)
        found = set()
        for number, spans in windows.items():
            notice, label, edits = self.notices[number]
            merged: list[list[int]] = []
            for low, high in sorted(spans):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            while merged:
                low, high = merged.pop()
                if high - low < len(notice) - edits:
                    continue
                if m := self.fuzzy[number].search(plain, low, high):
                    wrong = sum(m.fuzzy_counts)
                    found.add((label, m.start(), m.end(), wrong, 1 - wrong / len(notice)))
                    # The best match may be a later one; the sides end where a word does.
                    merged += [[low, m.start() - 1], [m.end(), high]]
        return sorted(found, key=lambda s: (s[1], s[2], s[0]))


_SCANNERS: dict[tuple, Scanner] = {}


def _scanner(notices: tuple, phrases: tuple) -> Scanner:
    """The process's scanner of those notices and phrases."""
    if (notices, phrases) not in _SCANNERS:
        _SCANNERS[notices, phrases] = Scanner(notices, dict(phrases))
    return _SCANNERS[notices, phrases]


SCANNED = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "spans array<struct<label: string, start: int, stop: int, edits: int, likeness: double>>"
)


def scan_licenses(docs: DataFrame, notices=NOTICES, phrases=PHRASES) -> DataFrame:
    """One row per row of ``docs``: word count, exact phrase places, and fuzzy notice spans.

    Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased. ``n_base`` counts all
    places of exact phrases, ``first_word`` and ``last_word`` are the smallest and largest
    word number among them (null without any), ``base_labels`` their labels, distinct and
    sorted. ``spans`` holds, in characters of the text's words joined by single spaces, each
    notice found within its edits: (label, start, stop, edits, likeness). A null or empty text has
    no words and no spans.
    """
    fixed = tuple(phrases.items())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(tuple(notices), fixed)
        for batch in slices(batches, ROWS_AT_ONCE):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                words = text.translate(WORD_BYTES).split()
                plain = b" ".join(words)
                base = scanner.exact_places(plain)
                rows.append(
                    (
                        doc_id,
                        len(words),
                        len(base),
                        base[0][0] if base else None,
                        base[-1][0] if base else None,
                        sorted({label for _, label in base}),
                        [
                            dict(zip(("label", "start", "stop", "edits", "likeness"), s, strict=True))
                            for s in scanner.spans(plain.decode())
                        ],
                    )
                )
            places = [(name, pa.int32()) for name in ("start", "stop", "edits")]
            span = pa.struct([("label", pa.string()), *places, ("likeness", pa.float64())])
            types = [pa.int64()] * 5 + [pa.list_(pa.string()), pa.list_(span)]
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "spans"]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return id_and_text(docs).mapInArrow(run, SCANNED)


def license_digest(scanned: DataFrame) -> DataFrame:
    """Labels and a score per document: 1 with an exact phrase, else the best likeness, else 0."""
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.col("spans.label"))))
    best = F.coalesce(F.array_max(F.col("spans.likeness")), F.lit(0.0))
    return scanned.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(best).alias("score"),
        "spans",
    )
