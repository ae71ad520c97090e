"""SimHash near-dedup: 64-bit fingerprints, pigeonhole blocks, Hamming distance verified.

Two fingerprints at ``max_bits`` or fewer differing bits agree on at least ``blocks - max_bits``
of ``blocks`` bit blocks, so they share the key of at least one choice of that many blocks.
Rows are dealt by key and only equal keys are compared. Shorter keys mean fewer rows to
shuffle and more candidates; seven blocks give 35 keys of 27 or 28 bits.

No pairs of a group are ever listed: equal fingerprints are one node, a run of equal keys
yields links that connect it (at most its size), and a run larger than ``RUN`` is cut into
pieces that are compared piece by piece in separate tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import free_name, id_and_text, slices, utf8, written
from .components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCKS = 7
RUN = 4096  # fingerprints of one key that are compared in one go
SMALL_RUN = 24
ROWS_AT_ONCE = 500
SHINGLES_AT_ONCE = 1 << 15


def _ones_per_bit(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit values have each bit set, bit 0 first."""
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 of every ``width``-word shingle, repeats included."""
    words = text.lower().split()  # bytes: A-Z only, and space plus tab to carriage return
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-width])).tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    total, count = np.zeros(64, np.int64), len(starts)
    for at in range(0, count, SHINGLES_AT_ONCE):
        part = zip(starts[at : at + SHINGLES_AT_ONCE], stops[at : at + SHINGLES_AT_ONCE], strict=True)
        hashed = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in part]
        total += _ones_per_bit(np.array(hashed, np.uint64))
    bits = (2 * total > count).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            prints = np.array([fingerprint(t, width) for t in utf8(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"]
            )

    return run


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """One 64-bit mask for each choice of ``blocks - max_bits`` of the bit blocks."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    spans = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(choice) for choice in combinations(spans, blocks - max_bits)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _connect(prints: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (member, root) that connect whatever is reachable within ``prints``."""
    rest = prints
    while len(rest):
        root, frontier, rest = rest[0], [rest[0]], rest[1:]
        while frontier and len(rest):
            near = np.bitwise_count(rest ^ frontier.pop()) <= max_bits
            if near.any():
                reached, rest = rest[near], rest[~near]
                frontier.extend(reached)
                yield reached, np.full(len(reached), root)


def _run_links(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links inside each run of equal keys; short runs of all rows are compared at once."""
    starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    for start, size in zip(starts[sizes > SMALL_RUN], sizes[sizes > SMALL_RUN], strict=True):
        yield from _connect(prints[start : start + size], max_bits)
    ends = np.repeat(starts + sizes, sizes)
    at = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SMALL_RUN), sizes))
    for step in range(1, SMALL_RUN):
        at = at[at + step < ends[at]]
        near = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= max_bits]
        if len(near):
            yield prints[near + step], prints[near]


def _whole_runs(batches: Iterable[pa.RecordBatch], limit: int):
    """Sorted (key, fp) rows -> (keys, prints, None) blocks of whole runs, and (keys, prints, first)
    blocks of a run longer than ``limit``, whose rows are numbered from ``first``."""
    keys, prints = np.empty(0, np.int64), np.empty(0, np.uint64)
    open_key, seen = None, 0
    for batch in chain(batches, [None]):
        if batch is not None:
            keys = np.concatenate((keys, batch.column(0).to_numpy()))
            prints = np.concatenate((prints, batch.column(1).to_numpy().view(np.uint64)))
        if open_key is not None:
            more = int(np.searchsorted(keys, open_key, "right"))
            yield keys[:more], prints[:more], seen
            seen, keys, prints = seen + more, keys[more:], prints[more:]
        if not len(keys):
            continue
        open_key, seen = None, 0
        cut = len(keys) if batch is None else int(np.searchsorted(keys, keys[-1], "left"))
        if cut:
            starts = np.concatenate(([0], np.flatnonzero(np.diff(keys[:cut])) + 1))
            sizes = np.diff(np.concatenate((starts, [cut])))
            for start, size in zip(starts[sizes > limit], sizes[sizes > limit], strict=True):
                yield keys[start : start + size], prints[start : start + size], 0
            short = np.repeat(sizes <= limit, sizes)
            yield keys[:cut][short], prints[:cut][short], None
        keys, prints = keys[cut:], prints[cut:]
        if len(keys) > limit:
            yield keys, prints, 0
            open_key, seen, keys, prints = keys[-1], len(keys), keys[:0], prints[:0]


LINKS = "a long, b long, key long, piece long"


def _compare(max_bits: int, limit: int):
    """Sorted (key, fp) rows -> links (a, b); rows of a run over ``limit`` pass on with key and piece."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, prints, first in _whole_runs(batches, limit):
            if first is not None:
                found = [(prints, prints)]
                extra = [pa.array(keys), pa.array((first + np.arange(len(keys))) // limit)]
            elif not (found := list(_run_links(keys, prints, max_bits)) if len(keys) else []):
                continue
            a, b = (np.concatenate(ends).view(np.int64) for ends in zip(*found, strict=True))
            if first is None:
                extra = [pa.nulls(len(a), pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *extra], names=["a", "b", "key", "piece"])

    return step


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, run: int = RUN) -> DataFrame:
    """Links ``(u, v)`` that connect the distinct fingerprints of ``prints(fp)`` as all pairs
    at ``max_bits`` or fewer differing bits would."""
    masks = block_masks(blocks, max_bits)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)])
    keyed = prints.select("fp", F.explode(keys).alias("key"))
    found = written(_dealt(keyed).mapInArrow(_compare(max_bits, run), LINKS), "simhash-links")
    links, over = found.where("key is null").select("a", "b"), found.where("key is not null")
    if not over.isEmpty():
        # A run too long for one task: every two of its pieces meet in a task of their own, which
        # compares them whatever their number.
        pieces = over.groupBy("key").agg((F.max("piece") + 1).alias("pieces"))
        meet = over.join(pieces, "key").select(
            F.col("a").alias("fp"), "key", "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other")
        )
        pair = F.xxhash64("key", F.least("piece", "other"), F.greatest("piece", "other"))
        again = _dealt(meet.select("fp", pair.alias("key")))
        links = links.unionByName(again.mapInArrow(_compare(max_bits, 1 << 62), LINKS).select("a", "b"))
    return links.select(F.col("a").alias("u"), F.col("b").alias("v"))


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    return id_and_text(docs).mapInArrow(_fingerprints(width), "doc_id long, fp long")


def _components(docs: DataFrame, width: int, max_bits: int, blocks: int, run: int) -> DataFrame:
    """(doc_id, fp, component, component_id) of each row: ``component`` is a fingerprint of its own."""
    prints = written(fingerprints(docs, width), "simhash-prints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    labels = connected_components(near_links(nodes.select("fp"), max_bits, blocks, run))
    named = nodes.join(labels, nodes["fp"] == labels["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "first_id"
    )
    # Written, so that each join shuffles both sides itself and may split a hot key.
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = named.join(written(smallest, "simhash-smallest"), "component").select("fp", "component", "component_id")
    return prints.join(written(known, "simhash-known"), "fp")


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, blocks: int = BLOCKS, run: int = RUN
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, fp, component_id).

    Texts are lower-cased (A-Z), split at space and tab to carriage return, and hashed as
    ``width``-word shingles (fewer words: the whole sequence; none: fingerprint zero).
    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` bits,
    the document itself included; null only if nothing reachable has an id. Empty and null
    texts share fingerprint zero and are linked like any other.
    """
    return _components(docs, width, max_bits, blocks, run).select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with its own columns and one row of each component: the one with the smallest id, null
    last; of several the one with the smallest fingerprint, and any of those that share both."""
    found = written(_components(docs, width, max_bits, BLOCKS, RUN), "simhash-groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("kept_id"), F.col("fp").alias("kept_fp")))
    kept = written(found.groupBy("component").agg(first.alias("r")).select("component", "r.kept_id", "r.kept_fp"), "simhash-kept")
    is_kept = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("fp") == F.col("kept_fp"))
    marked = found.join(kept, "component").select("doc_id", "fp", is_kept.alias("kept"))
    gone = marked.where("not kept").select(F.col("doc_id").alias("gone_id"))
    again = marked.where("kept").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    both = gone.join(kept, F.col("gone_id").eqNullSafe(F.col("kept_id")), "left_semi")
    if again.isEmpty() and both.isEmpty():  # ids tell the rows apart
        gone_ids = gone.distinct().hint("merge")
        return docs.join(gone_ids, docs["doc_id"].eqNullSafe(gone_ids["gone_id"]), "left_anti")
    print_of = F.pandas_udf(lambda s: s.fillna("").map(lambda t: _signed(fingerprint(t.encode(), width))), "long")
    name = free_name(docs, "_fp")
    keyed = docs.withColumn(name, print_of(F.col("text").cast("string")))
    on = keyed["doc_id"].eqNullSafe(kept["kept_id"]) & (keyed[name] == kept["kept_fp"])
    return keyed.join(kept.select("kept_id", "kept_fp"), on, "left_semi").dropDuplicates(["doc_id", name]).drop(name)
