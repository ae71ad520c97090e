"""Filter interaction audit: what each filter removes in every order, from wide packed counters.

A document fails some of five filters: its mask. In each of the 120 orders each of the five steps has
one outcome for a mask: the document is kept, removed here, or was removed before and fails this
filter too. All 600 outcomes of a mask, and whether it fails this step's filter alone, are fields of
one big integer. A part's audit is the sum of its documents' integers, taken apart once: a field has
64 bits and never exceeds the number of documents, so it cannot run over into the next.

Documents are counted by mask before their integers are added (a part has at most 128 kinds:
mask, good, toxic), so a hot part or a hot text is a few rows a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import slices, utf8, whole_groups

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(ORDERS) * len(FILTERS)  # 600

MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITAL_PERCENT = 10
SYMBOLS = b"#$%&*|"

COPY = FILTERS.index("E")
FIELD_BITS = 64
MEASURES = ("kept", "removed", "redundant", "unique_fails")
ROWS_AT_ONCE = 500

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_INSIDE = bytes(range(0x80, 0xC0))  # bytes that begin no code point

MARKED = "doc_id long, part string, mask int, digest binary"
AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def mask_of(text: bytes) -> int:
    """Bits 0 to 3: which of the filters A to D the text fails."""
    words = text.split()  # at space and tab to carriage return
    points = len(text.translate(None, _INSIDE))
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
        100 * (len(text) - len(text.translate(None, _CAPITALS))) > MAX_CAPITAL_PERCENT * points,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << i for i, fail in enumerate(fails) if fail)


def outcomes(mask: int) -> int:
    """All step outcomes of a mask as one integer: ``MEASURES`` blocks of 600 fields, step by step."""
    total = 0
    for number, order in enumerate(ORDERS):
        gone = False
        for step, letter in enumerate(order):
            bit = 1 << FILTERS.index(letter)
            fails = bool(mask & bit)
            marks = (not gone and not fails, not gone and fails, gone and fails, mask == bit)
            for block, mark in enumerate(marks):
                if mark:
                    total |= 1 << FIELD_BITS * (block * STEPS + number * len(FILTERS) + step)
            gone = gone or fails
    return total


def fields(total: int) -> np.ndarray:
    """A sum of such integers as (measure, step) counts."""
    data = total.to_bytes(len(MEASURES) * STEPS * FIELD_BITS // 8, "little")
    return np.frombuffer(data, "<u8").astype(np.int64).reshape(len(MEASURES), STEPS)


def _marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, ROWS_AT_ONCE):
        texts = utf8(batch.column(2))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([mask_of(t) for t in texts], pa.int32()),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            ],
            names=["doc_id", "part", "mask", "digest"],
        )


def _report(part: str, sums: list[int]) -> pa.RecordBatch:
    """The 600 rows of a part, from the sums over all, good and toxic documents."""
    every, good, toxic = (fields(s) for s in sums)
    letter = np.array([FILTERS.index(x) for order in ORDERS for x in order])
    removed = np.array([every[1][letter == i].sum() for i in range(len(FILTERS))])
    columns = [
        pa.array([part] * STEPS, pa.string()),
        pa.array([order for order in ORDERS for _ in FILTERS], pa.string()),
        pa.array(list(range(1, len(FILTERS) + 1)) * len(ORDERS), pa.int32()),
        *[pa.array(m) for m in every],
        pa.array(good[1]),
        pa.array(toxic[1]),
        pa.array(removed[letter]),
    ]
    return pa.RecordBatch.from_arrays(columns, names=AUDIT.replace(",", "").split()[::2])


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (part, mask, good, toxic, n) by part -> the audit of each part."""
    wide = [outcomes(mask) for mask in range(1 << len(FILTERS))]
    part, sums = None, [0, 0, 0]
    for batch in batches:
        for name, mask, good, toxic, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if name != part:
                if part is not None:
                    yield _report(part, sums)
                part, sums = name, [0, 0, 0]
            counted = n * wide[mask]
            sums[0] += counted
            sums[1] += counted * good
            sums[2] += counted * toxic
    if part is not None:
        yield _report(part, sums)


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): how many documents of each part fail the same filters."""
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = narrow.mapInArrow(_marked, MARKED).groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    known = known.agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    # Rows without id match no label and would all meet in one task of the join.
    named = rows.where("doc_id is not null").join(known, "doc_id", "left").na.fill(0, ["good", "toxic"])
    nameless = rows.where("doc_id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    kinds = named.unionByName(nameless).groupBy("digest", "part", "mask", "good", "toxic")
    texts = kinds.agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.min_by("n", "doc_id").alias("n_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_nameless"),
    )
    # A text has one row for each part and label kind here, so this window is small whatever the text.
    texts = texts.withColumn("first", F.min("least").over(Window.partitionBy("digest")))
    texts = texts.withColumn("own", F.col("n_nameless") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0))
    both = F.array(
        F.struct(F.col("mask").alias("mask"), F.col("own").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(1 << COPY)).alias("mask"), (F.col("n") - F.col("own")).alias("n")),
    )
    split = texts.select("part", "good", "toxic", F.explode(both).alias("r")).select("part", "r.mask", "good", "toxic", "r.n")
    return split.where("n > 0").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """600 rows for each ``lang`` of ``docs(doc_id, text, lang)``: (part, filter_order, step, counts).

    The filters fail a document that has A: under 100 words; B: under 80 distinct words in
    100; C: over 10 capitals A-Z in 100 code points; D: any of ``#$%&*|``; E: the text of a document
    of smaller id, anywhere in the table. A null text counts as empty, a null ``lang`` as the part ``''``.
    Without id a row is never a copy and makes no other row one; rows that share the
    smallest id of a text are no copies. Every row counts, repeated ones too. A document is good or
    toxic if any row of ``labels(doc_id, quality, toxic)`` for its id says 1. No documents, no rows.
    """
    counts = mask_counts(docs, labels)
    return counts.repartition("part").sortWithinPartitions("part").mapInArrow(_summed, AUDIT)
