"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A document is the set of its distinct word shingles, as 64-bit hashes; equal sets are one node,
named by a 128-bit digest. Tokens are ordered by document frequency, rarest first, ties by hash. A
set of ``n`` tokens that reaches ``percent`` with any other shares one of its first
``n - ceil(percent * n / 100) + 1`` tokens with it, so nodes are joined on those alone.

Frequencies come from a sketch over all documents: a fixed number of counters, each the sum of
the tokens that fall into it. Any order that is the same for all documents gives the same links,
so a counter shared by two tokens costs time only. The sketch is broadcast; its size is fixed.

Under a shared token a pair passes on if
* length: the smaller set has ``percent`` of the tokens of the larger one;
* position: the tokens from the shared one on suffice for the overlap it takes;
* suffix: the tokens behind it, counted in 16 ranges of hash values, differ by no more than the
  overlap allows (a lower bound of the distance of the suffixes).
The few that pass are held against finer counts, a range for about four tokens of the set, and
what is left is verified once, on the whole sets.

Pairs of a group are not all listed. Nodes under one token are first tried against the smallest
of them (stars), then one head of each component so found against the other heads, and at last
every pair that is still in two components. So no link between components is lost, and a group of
near copies costs about as many pairs as members. A token the sketch calls frequent is dealt in
pieces of ``piece`` nodes, each a task's work; in the last round every two of its pieces meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import id_and_text, slices, utf8, whole_groups, written
from .components import connected_components

WIDTH = 3
PERCENT = 90
PIECE = 4096
SMALL = 64  # groups whose pairs are all held against the filters at once
FOLD = 6  # a round joins 2**FOLD pieces of a frequent token
ROWS_AT_ONCE = 500
PAIRS_AT_ONCE = 1 << 16
SEEN_AT_ONCE = 1 << 16

SKETCH_BITS = 22  # 4 M counters, 16 MB once broadcast
BLOOM_BITS = 26  # 8 MB
SLICES = 1024

SIGNED = "doc_id long, n long, node binary, slice int, counts binary"
POSTED = "key long, salt long, pieces long, node binary, size long, low long, high long"
FOUND = "a binary, b binary, key long, salt long, pieces long, size long, low long, high long"


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The distinct ``width``-word shingles as sorted hashes; fewer words are one shingle."""
    words = text.lower().split()  # bytes: A-Z only, and space plus tab to carriage return
    width = min(width, len(words))
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for at in range(width):
        total *= np.uint64(0x9E3779B97F4A7C17)
        total += hashed[at : at + len(total)]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0x94D049BB133111EB)
    total ^= total >> np.uint64(29)
    return np.unique(total)


def node_of(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def overlap_needed(both: np.ndarray, percent: int) -> np.ndarray:
    """The least intersection of two sets of ``both`` tokens together that makes a link."""
    return -(-percent * both // (100 + percent))


# -- frequencies -------------------------------------------------------------------------------


def _sliced(values: np.ndarray, **columns) -> Iterator[pa.RecordBatch]:
    """A long array as rows (slice, bytes), in the narrowest type that holds it; zero slices are left out."""
    rows = values.reshape(SLICES, -1)
    some = np.flatnonzero(rows.any(axis=1))
    if not len(some):
        return
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if int(values.max()) <= np.iinfo(t).max)
    packed = pa.array([rows[i].astype(kind).tobytes() for i in some.tolist()], pa.binary())
    nulls = {name: pa.nulls(len(some), kind_of) for name, kind_of in columns.items()}
    yield pa.RecordBatch.from_pydict({**nulls, "slice": pa.array(some, pa.int32()), "counts": packed})


def _signatures(width: int):
    """Documents -> (doc_id, n, node), and the task's counters by slice."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint64)
        for batch in slices(batches, ROWS_AT_ONCE):
            sets = [shingles(t, width) for t in utf8(batch.column(1))]
            if sets:
                held = np.concatenate(sets) & np.uint64((1 << SKETCH_BITS) - 1)
                spots, times = np.unique(held, return_counts=True)
                counts[spots] += times.astype(np.uint64)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "node": pa.array([node_of(s) for s in sets], pa.binary()),
                    "slice": pa.nulls(len(sets), pa.int32()),
                    "counts": pa.nulls(len(sets), pa.binary()),
                }
            )
        yield from _sliced(counts, doc_id=pa.int64(), n=pa.int64(), node=pa.binary())

    return run


def _unpacked(data: bytes, length: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // length}").astype(np.uint64)


def _folded(length: int, fold):
    """Rows (slice, counts) of many tasks -> one row of each slice; a task holds one array a slice."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                new = _unpacked(data, length)
                held[at] = fold(held[at], new) if at in held else new
        if held:
            packed = pa.array([v.tobytes() for v in held.values()], pa.binary())
            yield pa.RecordBatch.from_pydict({"slice": pa.array(list(held), pa.int32()), "counts": packed})

    return run


def _gathered(rows: DataFrame, length: int, fold) -> np.ndarray:
    """The whole array of rows (slice, counts): fixed in size whatever the input."""
    whole = np.zeros((SLICES, length), np.uint64)
    dealt = rows.select("slice", "counts").repartition("slice")
    for row in dealt.mapInArrow(_folded(length, fold), "slice int, counts binary").collect():
        whole[row["slice"]] = _unpacked(bytes(row["counts"]), length)
    return whole.reshape(-1)


# -- candidates --------------------------------------------------------------------------------


def _postings(width: int, percent: int, sketch, usual: int, piece: int):
    """Documents -> a row of ``POSTED`` for each token of the prefix of each set the task meets first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = sketch.value, set()
        for batch in slices(batches, ROWS_AT_ONCE):
            out: list[tuple] = []
            for text in utf8(batch.column(1)):
                hashes = shingles(text, width)
                node = node_of(hashes)
                if not len(hashes) or node in seen:
                    continue
                if len(seen) >= SEEN_AT_ONCE:
                    seen.clear()
                seen.add(node)
                times = counts[hashes & np.uint64((1 << SKETCH_BITS) - 1)]
                first = np.argsort(times, kind="stable")[: prefix_length(len(hashes), percent)]
                ranges = (hashes >> np.uint64(60)).astype(np.int64)
                upto = np.cumsum(np.eye(16, dtype=np.int64)[ranges[first]], axis=0)
                behind = np.minimum(np.bincount(ranges, minlength=16) - upto, 255).astype(np.uint8).view("<i8")
                pieces = 1 + np.maximum(times[first].astype(np.int64) - usual, 0) // piece
                salt = int.from_bytes(node[:7], "little") % pieces
                size = (len(hashes) << 32) + np.arange(len(first))
                out.append((hashes[first].view(np.int64), salt, pieces, [node] * len(first), size, behind[:, 0], behind[:, 1]))
            if out:
                key, salt, pieces, nodes, size, low, high = zip(*out, strict=True)
                arrays = [pa.array(np.concatenate(c)) for c in (key, salt, pieces)]
                arrays.append(pa.array([n for ns in nodes for n in ns], pa.binary()))
                arrays += [pa.array(np.concatenate(c)) for c in (size, low, high)]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "salt", "pieces", "node", "size", "low", "high"])

    return run


class _Rows:
    """The columns of ``POSTED`` that the filters read."""

    def __init__(self, table: pa.Table) -> None:
        size = table["size"].to_numpy()
        self.n, self.at = size >> 32, size & 0xFFFFFFFF
        both = np.column_stack([table["low"].to_numpy(), table["high"].to_numpy()])
        self.behind = np.ascontiguousarray(both).view(np.uint8).astype(np.int16)
        self.left = self.n - self.at - 1  # tokens behind the shared one

    def pass_on(self, x, y, percent: int) -> np.ndarray:
        """Which pairs of rows (x, y) under one token may be links."""
        small, large = np.minimum(self.n[x], self.n[y]), np.maximum(self.n[x], self.n[y])
        need = overlap_needed(small + large, percent) - 1
        apart = np.abs(self.behind[x] - self.behind[y]).sum(axis=-1)
        return (
            (100 * small >= percent * large)
            & (np.minimum(self.left[x], self.left[y]) >= need)
            & (apart <= self.left[x] + self.left[y] - 2 * need)
        )


    def passing(self, start: int, stop: int, percent: int) -> int:
        """How many pairs of the rows ``start`` to ``stop`` may be links."""
        x, y = np.triu_indices(stop - start, 1)
        return int(self.pass_on(start + x, start + y, percent).sum())


def _stars(percent: int, names: list[str]):
    """Rows of ``POSTED`` sorted by ``names``, size, node -> rows of ``FOUND``: candidates (a, b), the
    smallest node of a group with each other that passes, again among those that do not; and the
    rows of groups that hold, or may hold, more pairs that pass, and of tokens in pieces (b null)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, names):
            keys = np.column_stack([table[n].to_numpy() for n in names])
            nodes = np.array(table["node"].to_pylist(), object)
            again = (keys[1:] == keys[:-1]).all(axis=1)
            keep = np.concatenate(([True], ~(again & (nodes[1:] == nodes[:-1]))))  # copies met by several tasks
            keys, nodes, rows = keys[keep], nodes[keep], _Rows(table.filter(pa.array(keep)))
            starts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1))
            sizes = np.diff(np.concatenate((starts, [len(keys)])))
            two = starts[sizes == 2]
            two = two[rows.pass_on(two, two + 1, percent)]
            a, b = [two], [two + 1]
            cut = table["pieces"].to_numpy()[keep] > 1  # the token's other pieces are elsewhere
            rest = [np.flatnonzero(cut)]
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                members = np.arange(start, start + size)
                tried = 0
                while len(members) > 1:
                    passed = rows.pass_on(np.full(len(members) - 1, members[0]), members[1:], percent)
                    a.append(np.full(int(passed.sum()), members[0]))
                    b.append(members[1:][passed])
                    tried += int(passed.sum())
                    members = members[1:][~passed]
                if not cut[start] and tried and (size > SMALL or rows.passing(start, start + size, percent) > tried):
                    rest.append(np.arange(start, start + size))
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):
                none = pa.nulls(len(a), pa.int64())
                ends = [pa.array(nodes[a].tolist(), pa.binary()), pa.array(nodes[b].tolist(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*ends, *[none] * 6], names=["a", "b", "key", "salt", "pieces", "size", "low", "high"])
            if len(rest := np.concatenate(rest)):
                untried = table.filter(pa.array(keep)).take(pa.array(rest))
                columns = [untried["node"].combine_chunks(), pa.nulls(untried.num_rows, pa.binary())]
                columns += [untried[c].combine_chunks() for c in ("key", "salt", "pieces", "size", "low", "high")]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "key", "salt", "pieces", "size", "low", "high"])

    return run


def _crossing(percent: int):
    """Rows of one token and two of its pieces -> every pair (a, b) that passes and lies in two components."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["key", "one", "other"]):
            keys = np.column_stack([table[n].to_numpy() for n in ("key", "one", "other")])
            nodes, rows = np.array(table["node"].to_pylist(), object), _Rows(table)
            part = table["component"].combine_chunks().dictionary_encode().indices.to_numpy()
            salt = table["salt"].to_numpy()
            starts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1))
            stops = np.concatenate((starts[1:], [len(keys)]))
            a: list[np.ndarray] = []
            b: list[np.ndarray] = []
            for start, stop in zip(starts.tolist(), stops.tolist(), strict=True):
                if (part[start:stop] == part[start]).all():
                    continue
                alone = keys[start, 1] == keys[start, 2]
                for x in range(start, stop - 1):
                    y = np.arange(x + 1, stop)
                    y = y[(part[y] != part[x]) & (alone | (salt[y] != salt[x]))]
                    y = y[rows.pass_on(np.full(len(y), x), y, percent)] if len(y) else y
                    if len(y):
                        a.append(np.full(len(y), x))
                        b.append(y)
                    if sum(map(len, a)) >= PAIRS_AT_ONCE:
                        yield _pairs(nodes, a, b)
                        a, b = [], []
            if a:
                yield _pairs(nodes, a, b)

    return run


def _pairs(nodes: np.ndarray, a: list, b: list) -> pa.RecordBatch:
    ends = [pa.array(nodes[np.concatenate(x)].tolist(), pa.binary()) for x in (a, b)]
    return pa.RecordBatch.from_arrays(ends, names=["a", "b"])


# -- verification ------------------------------------------------------------------------------


def _spots(node: bytes) -> list[int]:
    one, other = int.from_bytes(node[:8], "little"), int.from_bytes(node[8:], "little") | 1
    return [(one + k * other) % (1 << BLOOM_BITS) for k in range(4)]


def _bloom(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes -> the task's Bloom filter by slice."""
    bits = np.zeros(1 << (BLOOM_BITS - 3), np.uint8)
    for batch in batches:
        spots = np.array([s for node in batch.column(0).to_pylist() for s in _spots(node)], np.int64)
        np.bitwise_or.at(bits, spots >> 3, np.left_shift(1, spots & 7).astype(np.uint8))
    yield from _sliced(bits.view(np.uint64))


def _may_hold(bits: np.ndarray, node: bytes) -> bool:
    return all(bits[s >> 3] >> (s & 7) & 1 for s in _spots(node))


def signature(hashes: np.ndarray) -> bytes:
    """How many tokens lie in each of 16 or more equal ranges of hash values, about four a range."""
    bits = max(4, (len(hashes) // 4).bit_length())
    counts = np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype("<u2").tobytes() if counts.max() < 1 << 16 else b""


def least_distance(one: bytes, other: bytes) -> int:
    """A lower bound of the size of the symmetric difference, from two signatures."""
    x, y = (np.frombuffer(s, "<u2").astype(np.int64) for s in sorted((one, other), key=len))
    return int(np.abs(y.reshape(len(x), -1).sum(axis=1) - x).sum()) if len(x) else 0


def _sets(width: int, wanted):
    """Documents -> (node, n, signature, hashes) of the sets that the Bloom filter ``wanted`` may hold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = wanted.value, set()
        for batch in slices(batches, ROWS_AT_ONCE):
            out = []
            for text in utf8(batch.column(1)):
                hashes = shingles(text, width)
                node = node_of(hashes)
                if node in seen or not _may_hold(bits, node):
                    continue
                if len(seen) >= SEEN_AT_ONCE:
                    seen.clear()
                seen.add(node)
                out.append((node, len(hashes), signature(hashes), hashes.tobytes()))
            if out:
                columns = [pa.array(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "signature", "hashes"])

    return run


def _near(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            most = both - 2 * overlap_needed(both, percent)
            ones, others = batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist()
            keep = [least_distance(x, y) <= m for x, y, m in zip(ones, others, most.tolist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _held(wanted):
    """(node, hashes) rows -> those whose node the Bloom filter ``wanted`` may hold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_may_hold(wanted.value, node) for node in batch.column(0).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def _filter_of(nodes: DataFrame):
    """A broadcast Bloom filter of ``nodes(node)``, of fixed size."""
    slices_of = nodes.mapInArrow(_bloom, "slice int, counts binary")
    bits = _gathered(slices_of, (1 << BLOOM_BITS) // 64 // SLICES, np.bitwise_or)
    return nodes.sparkSession.sparkContext.broadcast(bits.view(np.uint8))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).where("node is not null")


def _linked(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            keep = []
            for one, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach ``percent``, as written links (u, v).

    The signatures, a thirtieth of the sets in size, decide first; only sets that are left in a
    pair are shuffled, in both joins by a hash of their node.
    """
    named = lambda end: sets.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("signature").alias(f"s_{end}"))
    signed = pairs.join(named("a").hint("merge"), "a").join(named("b").hint("merge"), "b")
    near = written(signed.mapInArrow(_near(percent), "a binary, b binary"), "jaccard-near")
    held = sets.select("node", "hashes").mapInArrow(_held(_filter_of(_ends(near))), "node binary, hashes binary")
    ones, others = (held.select(F.col("node").alias(end), F.col("hashes").alias(f"of_{end}")).hint("merge") for end in "ab")
    both = near.join(ones, "a").join(others, "b").select("a", "b", "of_a", "of_b")
    links = both.mapInArrow(_linked(percent), "a binary, b binary")
    return written(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "jaccard-links")


def _named(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` with the component of each; a node without links is its own."""
    labels = connected_components(links)
    known = nodes.join(labels, nodes["node"] == labels["node"], "left").drop(labels["node"])
    return known.withColumn("component", F.coalesce("component", "node"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _links(docs: DataFrame, signed: DataFrame, width: int, percent: int, piece: int) -> DataFrame:
    """Links (u, v) between nodes that connect them as all links would."""
    spark, docs = docs.sparkSession, id_and_text(docs)
    counts = _gathered(signed.where("slice is not null"), (1 << SKETCH_BITS) // SLICES, np.add)
    usual = int(counts.mean() + 4 * counts.mean() ** 0.5)  # what chance alone puts into a counter
    sketch = spark.sparkContext.broadcast(np.minimum(counts, (1 << 32) - 1).astype(np.uint32))
    posted = docs.mapInArrow(_postings(width, percent, sketch, usual, piece), POSTED)

    dealt = posted.repartition("key", "salt").sortWithinPartitions("key", "salt", "size", "node")
    found = written(dealt.mapInArrow(_stars(percent, ["key", "salt"]), FOUND), "jaccard-found")
    tried = written(_ordered(found.where("b is not null")), "jaccard-tried")
    rest = found.where("b is null").withColumnRenamed("a", "node").drop("b")

    fetched = docs.mapInArrow(_sets(width, _filter_of(_ends(found))), "node binary, n long, signature binary, hashes binary")
    row = F.first(F.struct("n", "signature", "hashes")).alias("r")
    sets = written(fetched.groupBy("node").agg(row).select("node", "r.*"), "jaccard-sets")

    links = _verified(tried, sets, percent)
    most = rest.agg(F.max("pieces")).first()[0]
    if most is None:
        return links
    level, row = 0, F.struct("size", "node", "pieces", "low", "high")
    while True:  # heads of components meet, 2**FOLD pieces more in each round
        level += 1
        folded = F.shiftright("salt", FOLD * level).alias("salt")
        heads = _named(rest, links).groupBy("key", folded, "component").agg(F.min(row).alias("r")).select("key", "salt", "r.*")
        dealt = heads.repartition("key", "salt").sortWithinPartitions("key", "salt", "size", "node")
        more = dealt.select(*POSTED.replace(",", "").split()[::2]).mapInArrow(_stars(percent, ["key", "salt"]), FOUND)
        new = written(_ordered(more.where("b is not null")).join(tried, ["a", "b"], "left_anti"), "jaccard-heads")
        tried, links = tried.unionByName(new), links.unionByName(_verified(new, sets, percent))
        if 1 << (FOLD * level) >= most:
            break
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))
    meet = _named(rest, links).withColumn("other", others)
    meet = meet.withColumn("one", F.least("salt", "other")).withColumn("other", F.greatest("salt", "other"))
    dealt = meet.repartition("key", "one", "other").sortWithinPartitions("key", "one", "other", "size", "node")
    last = _ordered(dealt.mapInArrow(_crossing(percent), "a binary, b binary")).join(tried, ["a", "b"], "left_anti")
    return links.unionByName(_verified(written(last, "jaccard-last"), sets, percent))


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, piece: int = PIECE) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id).

    Texts are lower-cased (A-Z) and split at space and tab to carriage return. Two documents link
    when their sets of distinct ``width``-word shingles (fewer words: the whole sequence) have an
    intersection of at least ``percent`` hundredths of their union. ``component_id`` is the
    smallest id reachable by links, the document itself included; null only if nothing reachable has
    an id. Null and empty texts have no shingles, link with nothing and are their own component.
    Rows that repeat an id or a text are documents of their own. No rows give no rows.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must be 1 to 100")
    signed = written(id_and_text(docs).mapInArrow(_signatures(width), SIGNED), "jaccard-signed")
    rows = signed.where("slice is null").select("doc_id", "n", "node")
    links = _links(docs, signed, width, percent, piece)
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    named = written(_named(nodes, links), "jaccard-named")
    # Written, so that each join shuffles both sides itself and may split a hot key.
    smallest = written(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "jaccard-smallest")
    known = written(named.join(smallest, "component").select("node", "component_id"), "jaccard-known")
    linked = rows.where("n > 0").join(known, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
