"""Hard-negative mining by exact integer inner products of anchors with all rows.

Components are ``floor(scale * x)``. Scores come in tiles, anchors by candidates, each multiplied by
Strassen's recursion on int64 matrices, padded with zeros to even sizes. All sums are exact: they are
taken modulo 2**64, and every score between rows whose squares add up to less than 2**62 is below
2**62 itself. Rows beyond that (lengths of 8 million and more) cannot be scored in 64 bits and take no part.

The first pass keeps, for each anchor, a heap of the best rows of its label (the positives); their
scores give windows, and the second pass keeps a heap of the best rows of other labels in each
window. Heaps are cut to their size in each task and merged by anchor across tasks.

Anchors are dealt into blocks of bounded bytes and candidates into parts; each block meets each
part in one task, which holds the block and reads the part tile by tile. No row is a hot key: blocks and
parts are dealt by a hash of the row's own number, whatever its label or vector.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import slices, whole_groups, written

SCALE = 256
ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)  # percent of the positive's score

LEAF = 32  # sides from which a product is split once more
ANCHORS_AT_ONCE = 256
TILE = 1024
BLOCK_BYTES = 32 << 20
PARTS_PER_BLOCK = 64
NORM_LIMIT = float(1 << 62)
EMPTY = -(1 << 63)

KEPT = "vec_id long, label long, v binary"
HEAP = "anchor long, slot long, score long, nameless boolean, id long"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices, exact modulo 2**64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    whole = np.empty((a.shape[0], b.shape[1]), np.int64)
    whole[:i, :h] = p1 + p4 - p5 + p7
    whole[:i, h:] = p3 + p5
    whole[i:, :h] = p2 + p4
    whole[i:, h:] = p1 - p2 + p3 + p6
    return whole[:m, :n]


class Heaps:
    """For each slot the first ``size`` of what was pushed: higher scores, then smaller ids, null last.

    Rows (slot, score, nameless, id) in that order; merging two is pushing one's rows to the other.
    """

    def __init__(self, slots: int, size: int) -> None:
        self.size, self.slots = size, slots
        self.rows = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))
        self.worst = np.full(slots, EMPTY)  # what a row must reach to change the heap

    def push(self, *rows: np.ndarray) -> None:
        slot, score, nameless, ids = (np.concatenate(both) for both in zip(self.rows, rows, strict=True))
        order = np.lexsort((ids, nameless, -score, slot))
        slot = slot[order]
        first = np.concatenate(([True], slot[1:] != slot[:-1])) if len(slot) else np.empty(0, bool)
        rank = np.arange(len(slot)) - np.maximum.accumulate(np.where(first, np.arange(len(slot)), 0))
        keep = rank < self.size
        self.rows = tuple(c[keep] for c in (slot, score[order], nameless[order], ids[order]))
        full = rank[keep] == self.size - 1
        self.worst[self.rows[0][full]] = self.rows[1][full]


def _kept(batches: Iterable[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, vector of doubles) -> the rows that take part, components as 32-bit integers."""
    for batch in slices(batches, 4 * TILE):
        lists = batch.column(2)
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null: not a number
        row = np.repeat(np.arange(len(lengths)), lengths)
        with np.errstate(over="ignore", invalid="ignore"):
            value = np.floor(flat * scale)
            bad = ~np.isfinite(value)
            squares = np.bincount(row, np.where(bad, NORM_LIMIT, value * value), len(lengths))
        keep = (squares < NORM_LIMIT) & lists.is_valid().to_numpy(zero_copy_only=False)
        keep &= batch.column(1).is_valid().to_numpy(zero_copy_only=False)
        stops = np.cumsum(lengths)
        packed = np.where(bad | ~keep[row], 0, value).astype("<i4")
        at = np.flatnonzero(keep)
        vectors = [packed[stops[i] - lengths[i] : stops[i]].tobytes() for i in at.tolist()]
        chosen = batch.select([0, 1]).take(pa.array(at))
        yield pa.RecordBatch.from_arrays([*chosen.columns, pa.array(vectors, pa.binary())], names=["vec_id", "label", "v"])


def _matrix(vectors: list[bytes], width: int = 0) -> np.ndarray:
    """Rows of 32-bit components as int64, shorter rows filled up with zeros."""
    arrays = [np.frombuffer(v, "<i4") for v in vectors]
    whole = np.zeros((len(arrays), max([width, *map(len, arrays)])), np.int64)
    for at, row in enumerate(arrays):
        whole[at, : len(row)] = row
    return whole


class _Block:
    """Anchors of a cell, each with the windows it wants rows in, and their heaps."""

    def __init__(self, tables: list[pa.Table], size: int, same: bool) -> None:
        table = pa.concat_tables(tables)
        self.key, self.label = table["key"].to_numpy(), table["label"].to_numpy()
        self.vectors, self.same = _matrix(table["v"].to_pylist()), same
        windows = [(at, *w) for at, ws in enumerate(table["windows"].to_pylist()) for w in ws]
        columns = np.array(windows, np.int64).reshape(-1, 4)  # anchor, slot, low, high
        columns = columns[np.argsort(columns[:, 0], kind="stable")]
        self.anchor, self.slot, self.low, self.high = columns.T
        self.heaps = Heaps(len(columns), size)

    def read(self, table: pa.Table) -> None:
        """Score a tile of candidates and push what belongs into the heaps."""
        key, label = table["key"].to_numpy(), table["label"].to_numpy()
        nameless = table["vec_id"].is_null().to_numpy()
        ids = pc.fill_null(table["vec_id"], 0).to_numpy()
        tile = _matrix(table["v"].to_pylist(), self.vectors.shape[1])
        columns = np.ascontiguousarray(tile.T)
        mine = self.vectors
        if tile.shape[1] > mine.shape[1]:
            mine = np.pad(mine, ((0, 0), (0, tile.shape[1] - mine.shape[1])))
        for at in range(0, len(mine), ANCHORS_AT_ONCE):
            scores = strassen(mine[at : at + ANCHORS_AT_ONCE], columns)
            fit = (self.label[at : at + len(scores), None] == label) == self.same
            fit &= self.key[at : at + len(scores), None] != key
            low, high = np.searchsorted(self.anchor, (at, at + len(scores)))
            for start in range(low, high, ANCHORS_AT_ONCE):
                self._push(slice(start, min(start + ANCHORS_AT_ONCE, high)), at, scores, fit, nameless, ids)

    def _push(self, part: slice, base: int, scores, fit, nameless, ids) -> None:
        row = self.anchor[part] - base
        mine = scores[row]
        least = np.maximum(self.low[part], self.heaps.worst[part])
        wanted = fit[row] & (mine >= least[:, None]) & (mine <= self.high[part, None])
        size = self.heaps.size
        if wanted.sum() > 4 * size * len(row) and mine.shape[1] > size:
            masked = np.where(wanted, mine, EMPTY)
            wanted &= mine >= np.partition(masked, -size, axis=1)[:, -size, None]
        slot, at = np.nonzero(wanted)
        if len(slot):
            self.heaps.push(slot + part.start, mine[slot, at], nameless[at], ids[at])

    def rows(self) -> pa.RecordBatch:
        slot, score, nameless, ids = self.heaps.rows
        arrays = [pa.array(c) for c in (self.key[self.anchor[slot]], self.slot[slot], score, nameless)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(ids, mask=nameless)], names=HEAP.replace(",", "").split()[::2])


def _cells(size: int, same: bool):
    """Rows by (block, part), anchors first -> the heaps of each cell as rows of ``HEAP``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, anchors, block = None, [], None
        for batch in batches:
            keys = np.column_stack([batch.column(n).to_numpy() for n in ("block", "part")])
            side = batch.column("candidate").to_numpy(zero_copy_only=False)
            change = (keys[1:] != keys[:-1]).any(axis=1) | (side[1:] != side[:-1])
            edges = np.concatenate(([0], np.flatnonzero(change) + 1, [len(keys)])) if len(keys) else np.empty(0, np.int64)
            for start, stop in zip(edges.tolist(), edges[1:].tolist(), strict=False):
                if tuple(keys[start]) != cell:
                    if block is not None:
                        yield block.rows()
                    cell, anchors, block = tuple(keys[start]), [], None
                rows = pa.Table.from_batches([batch.slice(start, stop - start)])
                if not side[start]:
                    anchors.append(rows)
                    continue
                if block is None and anchors:
                    block, anchors = _Block(anchors, size, same), []
                if block is not None:
                    for at in range(0, rows.num_rows, TILE):
                        block.read(rows.slice(at, TILE))
        if block is not None:
            yield block.rows()

    return run


def _merged(size: int):
    """Rows of ``HEAP`` by (anchor, slot), of many tasks -> the first ``size`` of each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["anchor", "slot"]):
            keys = np.column_stack([table["anchor"].to_numpy(), table["slot"].to_numpy()])
            number = np.cumsum(np.concatenate(([0], (keys[1:] != keys[:-1]).any(axis=1))))
            heaps = Heaps(int(number[-1]) + 1, size)
            ids = pc.fill_null(table["id"], 0).to_numpy()
            heaps.push(number, table["score"].to_numpy(), table["nameless"].to_numpy(), ids)
            slot, score, nameless, ids = heaps.rows
            of = keys[np.searchsorted(number, slot)]
            arrays = [pa.array(c) for c in (of[:, 0], of[:, 1], score, nameless)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(ids, mask=nameless)], names=HEAP.replace(",", "").split()[::2])

    return run


def _best(rows: DataFrame, anchors: DataFrame, cells: tuple[int, int], size: int, same: bool, name: str) -> DataFrame:
    """The first ``size`` rows in each window of each of ``anchors(key, label, v, windows)``."""
    blocks, parts = cells
    hashed = lambda n: F.pmod(F.xxhash64("key"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    none = F.lit(None).cast(anchors.schema["windows"].dataType)
    left = anchors.select(
        hashed(blocks).alias("block"), every(parts).alias("part"), F.lit(False).alias("candidate"),
        "key", F.lit(None).cast("long").alias("vec_id"), "label", "v", "windows")
    right = rows.select(
        every(blocks).alias("block"), hashed(parts).alias("part"), F.lit(True).alias("candidate"),
        "key", "vec_id", "label", "v", none.alias("windows"))
    tasks = min(blocks * parts, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = left.unionByName(right).repartition(tasks, "block", "part").sortWithinPartitions("block", "part", "candidate")
    heaps = dealt.mapInArrow(_cells(size, same), HEAP)
    by_anchor = heaps.repartition("anchor", "slot").sortWithinPartitions("anchor", "slot")
    return written(by_anchor.mapInArrow(_merged(size), HEAP), name)


def share(score, percent: int):
    """``percent`` hundredths of a long column, rounded down, without overflow."""
    hundred = F.lit(100).cast("long")
    rest = F.pmod(score, hundred)
    return F.call_function("div", score - rest, hundred) * percent + F.call_function("div", rest * percent, hundred)


def mine_hard_negatives(
    vectors: DataFrame,
    every: int = ANCHOR_EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over ``vectors(vec_id, embedding, label)``.

    Anchors are the rows whose ``vec_id`` is divisible by ``every``. Rows with a null label or
    vector, or a component that is null or not finite, take no part. Vectors of different
    length are filled up with zeros; an empty one scores 0. Rows with a null ``vec_id`` are no anchors,
    and come last among equal scores. Rows that share an id are rows of their own: each is an anchor,
    and a positive or negative of the others. An anchor without positives, or a positive without a
    negative in its window, gives no row. No rows give no rows.
    """
    plain = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    kept = plain.mapInArrow(lambda batches: _kept(batches, scale), KEPT)
    rows = written(kept.withColumn("key", F.monotonically_increasing_id()), "negatives-rows")
    is_anchor = F.col("vec_id") % every == 0
    n, n_anchors, widest = rows.agg(F.count("*"), F.count_if(is_anchor), F.max(F.length("v"))).first()
    blocks = max(1, -(-n_anchors * 2 * max(widest or 0, 64) // BLOCK_BYTES))
    cells = blocks, max(1, min(-(-n // TILE), PARTS_PER_BLOCK * blocks))

    anchors = rows.where(is_anchor)
    limit = F.lit(1 << 62).cast("long")
    all_scores = F.array(F.array(F.lit(0).cast("long"), -limit, limit))
    best = _best(rows, anchors.withColumn("windows", all_scores), cells, positives, True, "negatives-positives")
    scored = best.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    low, high = -share(-F.col("positive_score"), window[0]), share(F.col("positive_score"), window[1])
    spans = scored.select("anchor", F.array("positive_score", low, high).alias("w")).groupBy("anchor")
    windows = spans.agg(F.collect_set("w").alias("windows")).withColumnRenamed("anchor", "key")  # ``positives`` at most
    found = _best(rows, anchors.join(windows, "key"), cells, negatives, False, "negatives-found")
    ranked = found.groupBy("anchor", "slot").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "nameless", "id"))).alias("heap"))
    listed = ranked.select("anchor", F.col("slot").alias("positive_score"), F.posexplode("heap").alias("at", "row"))
    names = anchors.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return scored.join(listed, ["anchor", "positive_score"]).join(names, "anchor").select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"),
        F.col("row.id").alias("negative_id"), "positive_score", (-F.col("row.less")).alias("negative_score"))
