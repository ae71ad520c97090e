"""Sharding: best-fit-decreasing bin packing of indivisible groups into shards of near equal size.

Two levels. Spark deals the groups into buckets; a task packs its bucket, largest group first,
into boxes of a small fixed capacity, each group into the open box with the tightest room
that still fits it, found in a balanced tree. A group larger than a box is a box of its own.
The driver then packs the boxes into the shards by the same rule, with the smallest capacity
for which they suffice. It sees at most ``2 * shards * BOXES`` boxes and one more per bucket, whatever the
number of rows; no group, however hot, is gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .common import id_and_text, written

BOXES = 256  # boxes that would fill a shard
SLOT_PARTS = 256
SEARCH_STEPS = 16


class RoomTree:
    """A balanced (AVL) search tree of (room, bin): insert, and take the tightest that fits."""

    def __init__(self):
        self.root = None

    def insert(self, room: int, name: int) -> None:
        self.root = _insert(self.root, (room, name))

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the entry with the least room of at least ``size``; the first bin of ties."""
        best, node = None, self.root
        while node:
            if node[0] >= (size, -1):
                best, node = node[0], node[1]
            else:
                node = node[2]
        if best:
            self.root = _remove(self.root, best)
        return best


def _height(node) -> int:
    return node[3] if node else 0


def _node(entry, left, right) -> tuple:
    return (entry, left, right, 1 + max(_height(left), _height(right)))


def _balanced(entry, left, right) -> tuple:
    if _height(left) > _height(right) + 1:
        if _height(left[1]) < _height(left[2]):
            inner = left[2]
            return _node(inner[0], _node(left[0], left[1], inner[1]), _node(entry, inner[2], right))
        return _node(left[0], left[1], _node(entry, left[2], right))
    if _height(right) > _height(left) + 1:
        if _height(right[2]) < _height(right[1]):
            inner = right[1]
            return _node(inner[0], _node(entry, left, inner[1]), _node(right[0], inner[2], right[2]))
        return _node(right[0], _node(entry, left, right[1]), right[2])
    return _node(entry, left, right)


def _insert(node, entry) -> tuple:
    if node is None:
        return _node(entry, None, None)
    if entry < node[0]:
        return _balanced(node[0], _insert(node[1], entry), node[2])
    return _balanced(node[0], node[1], _insert(node[2], entry))


def _remove(node, entry):
    if entry < node[0]:
        return _balanced(node[0], _remove(node[1], entry), node[2])
    if entry > node[0]:
        return _balanced(node[0], node[1], _remove(node[2], entry))
    if node[1] is None or node[2] is None:
        return node[1] or node[2]
    follower = node[2]
    while follower[1]:
        follower = follower[1]
    return _balanced(follower[0], node[1], _remove(node[2], follower[0]))


class Boxes:
    """Best fit into boxes of one capacity, opened as needed; sizes should come largest first."""

    def __init__(self, capacity: int):
        self.capacity, self.tree, self.count = capacity, RoomTree(), 0

    def put(self, size: int) -> int:
        found = self.tree.take(size) if size <= self.capacity else None
        if found:
            room, box = found
        else:
            room, box = self.capacity, self.count
            self.count += 1
        if room > size:
            self.tree.insert(room - size, box)
        return box


def _assign(sizes: list[int], shards: int) -> list[int]:
    """Shard of each size (largest first): best fit under the least capacity that suffices.

    A size above an even share of what is left has a shard to itself.
    """
    result, first, total = [0] * len(sizes), 0, sum(sizes)
    while first < min(len(sizes), shards - 1) and sizes[first] * (shards - first) > total:
        result[first] = first
        total -= sizes[first]
        first += 1
    rest, bins = sizes[first:], shards - first
    if not rest:
        return result
    low, high = max(-(-total // bins), rest[0]), 2 * max(total // bins, rest[0]) + 1
    chosen = None
    for _ in range(SEARCH_STEPS):
        middle = (low + high) // 2
        boxes = Boxes(middle)
        placed = [boxes.put(size) for size in rest]
        if boxes.count <= bins:
            chosen, high = placed, middle
        else:
            low = middle + 1
        if low >= high:
            break
    if chosen is None:
        boxes = Boxes(high)
        chosen = [boxes.put(size) for size in rest]
    result[first:] = [first + box for box in chosen]
    return result


def _box_rows(capacity: int):
    """Rows (bucket, size, key) by bucket and falling size -> (key, bucket, box, size)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, boxes = None, None
        for batch in batches:
            found = []
            for bucket, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != current:
                    current, boxes = bucket, Boxes(capacity)
                found.append(boxes.put(size))
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(0), pa.array(found, pa.int64()), batch.column(1)],
                names=["key", "bucket", "box", "size"],
            )

    return run


def shard_groups(groups: DataFrame, shards: int, buckets: int | None = None) -> DataFrame:
    """(key, shard) of each row of ``groups(key, size)``: sizes near equal, no group divided.

    ``key`` is binary and unique, ``size`` a positive bigint. ``buckets`` is the number of tasks
    of the first level, by default the session's shuffle partitions. An empty input gives an
    empty result.
    """
    spark = groups.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = groups.agg(F.sum("size")).first()[0] or 0
    capacity = max(1, total // (shards * BOXES))
    dealt = (
        groups.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "size", "key")
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", F.col("size").desc(), "key")
    )
    boxed = written(dealt.mapInArrow(_box_rows(capacity), "key binary, bucket long, box long, size long"), "shard-boxes")
    sums = boxed.groupBy("bucket", "box").agg(F.sum("size").alias("size")).orderBy(F.desc("size"), "bucket", "box")
    boxes = sums.collect()
    placed = _assign([b["size"] for b in boxes], shards)
    shard_of = spark.createDataFrame(
        [(b.bucket, b.box, shard) for b, shard in zip(boxes, placed, strict=True)], "bucket long, box long, shard int"
    )
    return boxed.join(F.broadcast(shard_of), ["bucket", "box"]).select("key", "shard")


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """One row per row of ``docs``: (doc_id, size, text_crc32, shard, slot).

    ``size`` is the text's UTF-8 bytes (null: none) plus 8. Documents of equal text are a
    group and share a shard; null and empty texts are one group. Shards have near equal
    sizes; a group above an even share has a shard to itself. ``slot`` numbers the rows of a
    shard without gaps from 0, repeated rows each.
    """
    source = id_and_text(docs)
    octets = F.col("text").cast("binary")
    rows = written(
        source.select(
            "doc_id",
            (F.octet_length("text") + 8).cast("bigint").alias("size"),
            F.crc32(octets).alias("text_crc32"),
            F.unhex(F.md5(octets)).alias("key"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"))
    placed = rows.join(shard_groups(groups, shards), "key").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "key"), F.lit(SLOT_PARTS))
    )
    placed = written(placed, "shard-placed")
    # Slots: a running number inside each part of a shard, after the rows of the parts before.
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "key")
    numbered = placed.withColumn("at", F.row_number().over(inside))
    return numbered.join(F.broadcast(offsets), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("at") - 1).alias("slot")
    )
