"""Benchmark decontamination: BM25 index of the test items, block-max WAND, overlap verified.

Every document is cut into overlapping passages long enough that any stretch of words as long
as the longest item lies inside one. Each passage is a query against an inverted index of the
items, kept in blocks of similar items with every term's largest impact in the block. The
block maxima of all passages of a document are summed at once; only blocks whose sum reaches
the threshold are searched, item by item with a pivot as in WAND. All items above their
threshold come back, and the five-word shingles of question and answer are then looked up in
the passage.

The threshold loses nothing: a part of an item that keeps a shingle lacks at most as many
different words as shingles, a part that loses all of them may lack every word, so the score
of a passage with ``OVERLAP`` of the shingles is at least what the item keeps in the worst of
these cases. Impacts are stored as shares of that threshold, which makes it 1 for every item. The documents are scanned once for each ``SHARDS_AT_ONCE`` shards of the index and
never shuffled; a shard is bounded by ``SHARD_BYTES`` of item text and goes to the tasks with their
function.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import batched
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import id_and_text, slices, utf8, written

SHINGLE = 5
OVERLAP = 0.8
K1, B = 1.2, 0.75
BLOCKS = 64  # of an index; the block maxima are a table of terms by blocks
SHARD_BYTES = 1 << 20
SHARDS_AT_ONCE = 8  # shards that one scan of the documents asks, and a task holds
ROWS_AT_ONCE = 200
BOUNDS_AT_ONCE = 1 << 17
SLACK = 1e-4  # for sums of single-precision maxima

#: Bytes that belong to a word, lower-cased; every other byte becomes a space.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def _shingles(ids: list, width: int = SHINGLE) -> set[tuple[int, ...]]:
    width = min(width, len(ids))
    return set(_runs(ids, width)) if width else set()


def _runs(ids: list, width: int) -> Iterator[tuple]:
    return zip(*[ids[i:] for i in range(width)], strict=False)


class Item(NamedTuple):
    item_id: int | None
    question: set
    answer: set
    width: int  # of the question's shingles
    answer_width: int


def question_and_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """The words before and in an item's last sentence; the last third of a single sentence's."""
    sentences = [w for part in re.split(rb"[.?!\n]+(?=\s|$)", text) if (w := words_of(part))]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def _least_score(question: list[bytes], answer: list[bytes], weight: dict[bytes, float]) -> float:
    """The least a passage with ``OVERLAP`` of the shingles can score: the weight of the item's
    words less the heaviest, one a missing shingle, or less all words of the part that is gone."""

    def kept(words: Iterable[bytes], lacking: int) -> float:
        weights = sorted(weight[w] for w in words)
        return sum(weights[: max(1, len(weights) - lacking)])

    asked, answered = len(_shingles(question)), len(_shingles(answer))
    may_lack = int((1 - OVERLAP + 1e-9) * (asked + answered))
    least = kept(weight, may_lack)
    for gone, rest in ((asked, answer), (answered, question)):
        if 0 < gone <= may_lack:
            least = min(least, kept(set(rest), may_lack - gone))
    return least


class Statistics(NamedTuple):
    """Of all items: how many have words, how many words, the most words of one, and how many
    items hold each word."""

    items: int
    words: int
    longest: int
    holding: dict[bytes, int]


class Index:
    """Inverted index of some items for block-max WAND, with impacts as shares of the threshold."""

    def __init__(self, items: list[tuple[int | None, bytes]], all_items: Statistics | None = None):
        parts = [(i, *question_and_answer(t)) for i, t in items]
        parts = [p for p in parts if p[1] or p[2]]
        own = Statistics(
            len(parts),
            sum(len(q) + len(a) for _, q, a in parts),
            max((len(q) + len(a) for _, q, a in parts), default=0),
            Counter(w for _, q, a in parts for w in {*q, *a}),
        )
        total, words, self.longest, df = all_items or own  # passages are the same for every shard
        mean = words / max(total, 1)
        # Similar items side by side: their common words, the most common first, in order.
        parts.sort(key=lambda p: sorted((-df[w], w) for w in {*p[1], *p[2]}))
        texts = [q + a for _, q, a in parts]
        self.vocabulary: dict[bytes, int] = {}
        for text in texts:
            for word in text:
                self.vocabulary.setdefault(word, len(self.vocabulary))
        self.block_items = max(1, math.ceil(len(texts) / BLOCKS))
        self.items, self.thresholds = [], []
        self.maxima = np.zeros((len(self.vocabulary), math.ceil(len(texts) / self.block_items)), np.float32)
        #: By block: the (item, impact) entries of each of its terms, in order of the items.
        self.postings: list[dict[int, list[tuple[int, float]]]] = [defaultdict(list) for _ in self.maxima.T]
        for number, ((item_id, question, answer), text) in enumerate(zip(parts, texts, strict=True)):
            norm = K1 * (1 - B + B * len(text) / mean)
            weight = {
                w: math.log(1 + (total - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + norm)
                for w, n in Counter(text).items()
            }
            threshold = _least_score(question, answer, weight) * (1 - 1e-9)
            ids = {w: self.vocabulary[w] for w in weight}
            self.items.append(
                Item(
                    item_id,
                    _shingles([ids[w] for w in question]),
                    _shingles([ids[w] for w in answer]),
                    min(SHINGLE, len(question)),
                    min(SHINGLE, len(answer)),
                )
            )
            self.thresholds.append(threshold)
            block = number // self.block_items
            for w, value in weight.items():
                impact = value / threshold
                self.postings[block][ids[w]].append((number, impact))
                self.maxima[ids[w], block] = max(self.maxima[ids[w], block], impact)

    def search(self, terms: list[int], block: int) -> list[tuple[int, float]]:
        """(item number, score as a share of its threshold) of every item of a block at 1 or more."""
        most = self.maxima[:, block]
        # A cursor is [its item, its place in the entries, its entries, the term's maximum].
        lists = [(self.postings[block][t], float(most[t])) for t in terms if most[t]]
        cursors = [[entries[0][0], 0, entries, top] for entries, top in lists]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, None
            for cursor in cursors:
                bound += cursor[3]
                if bound >= 1 - SLACK:
                    pivot = cursor[0]
                    break
            if pivot is None:
                break
            if cursors[0][0] == pivot:
                score = sum(c[2][c[1]][1] for c in cursors if c[0] == pivot)
                if score >= 1:
                    found.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
            for cursor in cursors:
                entries = cursor[2]
                while cursor[1] < len(entries) and entries[cursor[1]][0] < target:
                    cursor[1] += 1
                cursor[0] = entries[cursor[1]][0] if cursor[1] < len(entries) else None
            cursors = [c for c in cursors if c[0] is not None]
        return found

    def leaks(self, text: bytes) -> list[tuple]:
        """(item_id, first_word, score, question_overlap, answer_overlap, overlap) of each item
        found in a text, from its best passage."""
        if not self.items:
            return []
        known = self.vocabulary.get
        terms = np.array([known(w, -1) for w in words_of(text)], np.int64)
        at = np.flatnonzero(terms >= 0)
        if not len(at):
            return []
        # Passages are two neighbouring stretches; the block maxima of a passage's different
        # words bound the score of every item of the block there.
        stretch, size = at // self.longest, len(self.maxima)
        pairs = np.unique(np.concatenate((stretch + 1, stretch)) * size + np.tile(terms[at], 2))
        passage, term = np.divmod(pairs, size)
        starts = np.flatnonzero(np.diff(passage, prepend=-1))
        ends = np.append(starts[1:], len(passage))
        best: dict[int, tuple] = {}
        rows_at_once = max(1, BOUNDS_AT_ONCE // self.maxima.shape[1])
        for low in range(0, len(starts), rows_at_once):
            span = slice(starts[low], ends[min(low + rows_at_once, len(starts)) - 1])
            part = starts[low : low + rows_at_once]
            bounds = np.add.reduceat(self.maxima[term[span]], part - part[0], axis=0)
            for row, block in zip(*np.nonzero(bounds >= 1 - SLACK), strict=True):
                self._verify(terms, int(passage[part[row]]) - 1, term[part[row] : ends[low + row]].tolist(), block, best)
        rows = []
        for number, ((overlap, score, start), asked, answered) in sorted(best.items()):
            item, start = self.items[number], -start
            ids = terms[start : start + 2 * self.longest].tolist()
            held = ((item.question, item.width), (item.answer, item.answer_width))
            first = min(n for part, w in held if w for n, s in enumerate(_runs(ids, w)) if s in part)
            rows.append(
                (
                    item.item_id,
                    start + first,
                    score * self.thresholds[number],
                    asked / len(item.question) if item.question else None,
                    answered / len(item.answer) if item.answer else None,
                    overlap,
                )
            )
        return sorted(rows, key=lambda r: (r[0] is None, r))

    def _verify(self, terms: np.ndarray, passage: int, inside: list[int], block: int, best: dict[int, tuple]) -> None:
        """Search one block for a passage; what overlaps enough enters ``best`` by item."""
        start, seen = max(passage, 0) * self.longest, {}
        ids = None
        for number, score in self.search(inside, block):
            item = self.items[number]
            if ids is None:
                ids = terms[start : (passage + 2) * self.longest].tolist()
            for width in {item.width, item.answer_width} - seen.keys():
                seen[width] = _shingles(ids, width) if width <= len(ids) else set()
            asked = len(item.question & seen[item.width])
            answered = len(item.answer & seen[item.answer_width])
            overlap = (asked + answered) / (len(item.question) + len(item.answer))
            if overlap >= OVERLAP - 1e-9:
                rank = (overlap, score, -start)
                if number not in best or rank > best[number][0]:
                    best[number] = (rank, asked, answered)


def _shards(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of about ``SHARD_BYTES`` of item text each, one after the other; their statistics
    are those of the whole benchmark."""
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    per_item = written(items.mapInArrow(_item_words, "words long, distinct array<binary>"), "benchmark-words")
    of_words = [F.coalesce(f("words"), F.lit(0)) for f in (F.sum, F.max)]
    n_items, n_words, longest = per_item.where("words > 0").agg(F.count("*"), *of_words).first()
    holding = per_item.select(F.explode("distinct").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    holding = written(holding, "benchmark-holding")
    count = max(1, math.ceil(total / SHARD_BYTES))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for number in range(count):
        rows = [(r.item_id, r.text.encode()) for r in items.where(shard == number).orderBy("item_id", "text").collect()]
        own = spark.createDataFrame([(w,) for w in {w for _, t in rows for w in words_of(t)}], "word binary")
        known = {bytes(r.word): r.n for r in holding.join(own, "word").collect()}  # the words of one shard
        yield Index(rows, Statistics(n_items, n_words, longest, known))


def _item_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [words_of(t) for t in utf8(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(map(len, words), pa.int64()), pa.array([sorted(set(w)) for w in words], pa.list_(pa.binary()))],
            names=["words", "distinct"],
        )


LEAKS = (
    "doc_id long, item_id long, first_word long, score double, question_overlap double, "
    "answer_overlap double, overlap double"
)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item it holds: (doc_id, item_id, first_word, score,
    question_overlap, answer_overlap, overlap).

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. ``overlap`` is
    the share of the five-word shingles of question and answer (a shorter part counts as one
    shingle) found in one passage, at least ``OVERLAP``; the BM25 ``score`` is that of the best
    passage, ``first_word`` the number of the first word of the shingles found in it. Passages
    are as long for every shard. Items and texts without words match nothing,
    repeated items and rows are reported each.
    """
    source, found = id_and_text(docs), None
    for indexes in batched(_shards(benchmark), SHARDS_AT_ONCE):

        def run(batches: Iterable[pa.RecordBatch], indexes=indexes) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, ROWS_AT_ONCE):
                rows = [
                    (doc_id, *leak)
                    for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True)
                    for index in indexes
                    for leak in index.leaks(text)
                ]
                if rows:
                    types = [pa.int64()] * 3 + [pa.float64()] * 4
                    names = [c.split()[0] for c in LEAKS.split(", ")]
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        part = source.mapInArrow(run, LEAKS)
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item; no shuffle."""
    at = docs.columns.index("text")
    for indexes in batched(_shards(benchmark), SHARDS_AT_ONCE):

        def run(batches: Iterable[pa.RecordBatch], indexes=indexes) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, ROWS_AT_ONCE):
                clean = [not any(index.leaks(t) for index in indexes) for t in utf8(batch.column(at))]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
