"""Which occurrences of a digest are not its first, and the stretches of documents they cover.

An occurrence is (digest, document, place). Digests have 128 bits, in two columns. A document is its
id and a key of its text, so rows that share an id, or have none, are told apart. A place packs where
it begins in its document, its words and its length, so places sort by their begin. The first occurrence
is the smallest (id, key, place); documents without id come last, under ``NO_ID`` and an odd
key. The same occurrence given twice counts once.

A hot digest never meets in one task: each task first combines what it holds, so of a digest
only one occurrence a batch is shuffled by digest. The others are known to be repeats and are
dealt by a number of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import free_name

LENGTH_BITS = 17
WORD_BITS = 16
LONGEST = 1 << 16
NO_ID = (1 << 63) - 1
SILENT = 1 << 16  # a length with this bit: the occurrence is a source, but no finding itself

FOUND = "digest long, more long, doc long, key long, place long, source long"
REPEATS = "doc long, key long, place long, source long"
SPANS = "doc_id long, start long, length long, source_ids array<bigint>, text_key long"


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key) of each row: ``key`` is a hash of the text, odd if there is no id."""
    doc_id, text = F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), text_key(doc_id, text).alias("key"))


def text_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(-2).cast("long")).bitwiseOR(doc_id.isNull().cast("long"))


def digests(values: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digests as two columns."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, values)), "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def places(starts: np.ndarray, lengths: np.ndarray, words: np.ndarray | int = 0) -> np.ndarray:
    return (starts.astype(np.int64) << (LENGTH_BITS + WORD_BITS)) | (words << LENGTH_BITS) | lengths.astype(np.int64)


def ids_or_last(column: pa.Array) -> list[int]:
    return pc.fill_null(column, NO_ID).to_pylist()


def _firsts(digest, more, doc, key, place) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in order: (is it the first of its digest, is it the row before once more)."""
    same = (digest[1:] == digest[:-1]) & (more[1:] == more[:-1])
    twice = same & (doc[1:] == doc[:-1]) & (key[1:] == key[:-1]) & (place[1:] == place[:-1])
    return np.concatenate(([True], ~same)), np.concatenate(([False], twice))


def combined(digest, more, doc, key, place) -> pa.RecordBatch:
    """The occurrences of one batch as rows of ``FOUND``: one of each digest is still open
    (source null), the others name the open one's document as their source."""
    order = np.lexsort((place, key, doc, more, digest))
    digest, more, doc, key, place = (x[order] for x in (digest, more, doc, key, place))
    open_ = np.zeros(len(digest), bool)
    source = doc
    if len(digest):
        first, twice = _firsts(digest, more, doc, key, place)
        lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        # Repeats travel by a number of their own, spread evenly.
        spread = (place.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + doc.view(np.uint64)).view(np.int64)
        digest = np.where(first, digest, digest ^ spread)
        gone = twice | (~first & (place & SILENT != 0))
        digest, more, doc, key, place, source, open_ = (x[~gone] for x in (digest, more, doc, key, place, doc[lead], first))
    arrays = [pa.array(x, pa.int64()) for x in (digest, more, doc, key, place)]
    return pa.RecordBatch.from_arrays(
        [*arrays, pa.array(source, pa.int64(), mask=open_)], names=["digest", "more", "doc", "key", "place", "source"]
    )


def _mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``FOUND`` by (digest, doc, key, place) -> the repeats, each with an earlier document."""
    last = None  # of the open rows: both digest columns, document of its first, document, key, place
    for batch in batches:
        digest, more, doc, key, place = (batch.column(i).to_numpy() for i in range(5))
        known = batch.column(5).is_valid().to_numpy(zero_copy_only=False)
        source = pc.fill_null(batch.column(5), 0).to_numpy()
        out = [(doc[known], key[known], place[known], source[known])]
        digest, more, doc, key, place = (x[~known] for x in (digest, more, doc, key, place))
        if len(digest):
            first, twice = _firsts(digest, more, doc, key, place)
            lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
            source = doc[lead]
            if last is not None and last[:2] == (digest[0], more[0]):  # the first run goes on from the batch before
                run = lead == 0
                source = np.where(run, last[2], source)
                first[0] = False
                twice[0] = last[3:] == (doc[0], key[0], place[0])
            last = (digest[-1], more[-1], source[-1], doc[-1], key[-1], place[-1])
            repeat = ~first & ~twice & (place & SILENT == 0)
            out.append((doc[repeat], key[repeat], place[repeat], source[repeat]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        if len(columns[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "key", "place", "source"])


def repeats(found: DataFrame) -> DataFrame:
    """The occurrences in ``found`` (rows of ``FOUND``) that are not the first of their digest."""
    dealt = found.repartition("digest").sortWithinPartitions("digest", "more", "doc", "key", "place")
    return dealt.mapInArrow(_mark, REPEATS)


def _span_rows(rows: list) -> pa.RecordBatch:
    doc, key, start, stop, sources, _ = zip(*rows, strict=True)
    none = lambda ids: [None if i == NO_ID else i for i in ids]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([None if k & 1 else d for d, k in zip(doc, key, strict=True)], pa.int64()),
            pa.array(start, pa.int64()),
            pa.array([b - a for a, b in zip(start, stop, strict=True)], pa.int64()),
            pa.array([none(sorted(s)) for s in sources], pa.list_(pa.int64())),
            pa.array(key, pa.int64()),
        ],
        names=["doc_id", "start", "length", "source_ids", "text_key"],
    )


def _merge(shortest: int, words: int | None):
    """Rows of ``REPEATS`` by (doc, key, place) -> spans of touching or overlapping repeats."""

    def long_enough(span: list) -> bool:
        return span[3] - span[2] >= shortest or (words is not None and span[5] >= words)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_span = None  # [doc, key, start, stop, sources, words]
        for batch in batches:
            done = []
            for d, k, p, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start, held = p >> (LENGTH_BITS + WORD_BITS), p >> LENGTH_BITS & ((1 << WORD_BITS) - 1)
                stop = start + (p & ((1 << LENGTH_BITS) - 1))
                if open_span and open_span[:2] == [d, k] and start <= open_span[3]:
                    open_span[5] += held if stop > open_span[3] else 0
                    open_span[3] = max(open_span[3], stop)
                    open_span[4].add(s)
                    continue
                if open_span and long_enough(open_span):
                    done.append(open_span)
                open_span = [d, k, start, stop, {s}, held]
            if done:
                yield _span_rows(done)
        if open_span and long_enough(open_span):
            yield _span_rows([open_span])

    return run


def spans(repeated: DataFrame, shortest: int, words: int | None = None) -> DataFrame:
    """(doc_id, start, length, source_ids, text_key) of the stretches that repeats cover, at least ``shortest``
    long or, if given, of at least ``words`` words.

    ``source_ids`` are documents that hold the parts of a stretch earlier, sorted, null last: the
    first of all, or the first among those of the task that read the document.
    """
    dealt = repeated.repartition("doc", "key").sortWithinPartitions("doc", "key", "place")
    return dealt.mapInArrow(_merge(shortest, words), SPANS)


def cut_texts(docs: DataFrame, found: DataFrame, cut) -> DataFrame:
    """``docs``, all columns, with ``cut(text, [{start, length}, ...])`` in place of ``text``.

    The spans of a document come sorted; there are no more of them than its text has room for.
    """
    name, key, text = free_name(docs, "_cuts"), free_name(docs, "_cut_id"), free_name(docs, "_cut_key")
    pairs = F.array_sort(F.collect_list(F.struct("start", "length")))
    cuts = found.groupBy(F.col("doc_id").alias(key), F.col("text_key").alias(text)).agg(pairs.alias(name))
    mine = text_key(docs["doc_id"], F.coalesce(docs["text"].cast("string"), F.lit("")))
    joined = docs.join(cuts, docs["doc_id"].eqNullSafe(cuts[key]) & (mine == cuts[text]), "left")
    without = F.pandas_udf(lambda texts, spans: texts.combine(spans, cut), "string")
    return joined.withColumn("text", without("text", name)).select(docs.columns)
