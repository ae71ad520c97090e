"""Exact dedup: 128-bit content hash, bytes compared inside each hash group, one document kept.

Shuffle plan: a narrow table (id, hash, length, digest) is written in one scan; groups are
aggregated map-side, so a group holding a third of all rows crosses the shuffle as one row
per task, and adaptive execution splits its narrow rows where they meet the group's. Only
documents of groups with several members bring their text to the byte comparison, which is a
grouping by (hash, text): copies collapse before that shuffle too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import free_name, id_and_text, slices, utf8, written

#: Characters that do not count in a comparison: space and the controls tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"

ROWS_AT_ONCE = 2000


def content_hash(text: bytes) -> bytes:
    """128 bits of a normalised text."""
    return hashlib.md5(text, usedforsecurity=False).digest()


def _plain(column: pa.Array) -> list[bytes]:
    return [t.translate(None, BLANKS.encode()) for t in utf8(column)]


def _digests(hasher):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            plain = _plain(batch.column(1))
            hashes = pa.array([hasher(t) for t in plain], pa.binary())
            shas = pa.array([hashlib.sha256(t).digest() for t in plain], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), hashes, shas, batch.column(2)], names=["doc_id", "h", "sha", "n_points"]
            )

    return run


def _normalised(hasher):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            plain = _plain(batch.column(1))
            columns = [batch.column(0), *(pa.array(c, pa.binary()) for c in (map(hasher, plain), plain))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "h", "plain"])

    return run


def _collided(docs: DataFrame, narrow: DataFrame, hasher) -> DataFrame:
    """Hashes under which different texts met, by comparing the bytes of every repeated hash."""
    # Written, here and below, so that a join shuffles both sides itself and may split a hot group.
    repeated = written(narrow.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "exact-repeated")
    ids = written(narrow.join(repeated, "h", "left_semi").select("doc_id", "h").distinct(), "exact-members")
    # By id and hash: rows that share an id, or have none, meet their own hash only.
    plain = id_and_text(docs).mapInArrow(_normalised(hasher), "doc_id long, h binary, plain binary").alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("d.h") == F.col("i.h"))
    members = plain.join(ids.hint("merge").alias("i"), same)
    texts = members.select("d.h", "d.plain").groupBy("h", "plain").agg(F.count("*").alias("n"))
    per_hash = texts.groupBy("h").agg(F.count("*").alias("texts"))
    return written(per_hash.where("texts > 1"), "exact-collided")


def exact_groups(docs: DataFrame, hasher=content_hash) -> DataFrame:
    """One row per row of ``docs``: (doc_id, sha, keep_id, group_size, kept).

    Two texts are equal when they are the same bytes after deleting the characters of
    ``BLANKS``. Of equal texts the row with the most code points in the original text stays,
    then the one with the smallest id; a null id comes last. A null text is an empty text,
    and empty texts form a group like any other. Rows that repeat both id and text are
    counted each, and are all marked kept when their id is.
    """
    source = id_and_text(docs).withColumn("n_points", F.length("text").cast("bigint"))
    narrow = written(
        source.mapInArrow(_digests(hasher), "doc_id long, h binary, sha binary, n_points long"), "exact-narrow"
    )
    collided = _collided(docs, narrow, hasher)
    if collided.isEmpty():
        keyed = narrow.withColumnRenamed("h", "key")
    else:  # the digest tells the texts of one hash apart
        mixed = F.col("texts").isNotNull()
        keyed = narrow.join(collided, "h", "left").select(
            "doc_id", F.when(mixed, F.concat("h", "sha")).otherwise(F.col("h")).alias("key"), "sha", "n_points"
        )
    first = F.min(F.struct((-F.col("n_points")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    groups = keyed.groupBy("key").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1")
    chosen = written(groups.select("key", F.col("first.doc_id").alias("keep"), "n"), "exact-chosen")
    alone = F.col("n").isNull()
    return keyed.join(chosen, "key", "left").select(
        "doc_id",
        "sha",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep"))).alias("kept"),
    )


def drop_exact_copies(docs: DataFrame, hasher=content_hash) -> DataFrame:
    """``docs`` with its own columns and one row of each group of equal texts.

    Rows that repeat a kept id and its text are reduced to one of them.
    """
    groups = written(exact_groups(docs, hasher), "exact-groups")
    gone = groups.where("not kept").select(F.col("doc_id").alias("gone_id"), "sha").distinct()
    repeats = (
        groups.where("kept and group_size > 1")
        .groupBy(F.col("doc_id").alias("again_id"), F.col("sha").alias("again_sha"))
        .agg(F.count("*").alias("n"))
        .where("n > 1")
    )
    kept_ids = groups.where("kept").select(F.col("doc_id").alias("kept_id"))
    shared = gone.join(kept_ids, F.col("gone_id").eqNullSafe(F.col("kept_id")), "left_semi")
    if repeats.isEmpty() and shared.isEmpty():  # ids tell the rows apart
        only_ids = gone.select("gone_id").distinct().hint("merge")
        return docs.join(only_ids, docs["doc_id"].eqNullSafe(only_ids["gone_id"]), "left_anti")
    plain = F.translate(F.coalesce(F.col("text"), F.lit("")), BLANKS, "")
    name = free_name(docs, "_sha")
    keyed = docs.withColumn(name, F.unhex(F.sha2(plain.cast("binary"), 256)))
    left = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["gone_id"]) & (keyed[name] == gone["sha"]), "left_anti")
    again = left["doc_id"].eqNullSafe(repeats["again_id"]) & (left[name] == repeats["again_sha"])
    once = left.join(repeats, again, "left_semi").dropDuplicates(["doc_id", name])
    return left.join(repeats, again, "left_anti").unionByName(once).drop(name)
