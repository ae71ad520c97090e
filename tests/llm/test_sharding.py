"""Sharding: even shards, whole groups, gapless slots; the tree against a sorted list."""

import zlib
from collections import defaultdict

from corpus_rows import ODD, pairs, read, table
from hypothesis import given, settings, strategies as st

from playlake.llm.sharding import Boxes, RoomTree, _assign, shard_documents


def check(rows, found, shards, slack):
    sizes, slots, places = defaultdict(int), defaultdict(list), defaultdict(set)
    texts = defaultdict(list)
    for i, t in rows:
        octets = (t or "").encode()
        texts[i, len(octets) + 8, zlib.crc32(octets)].append(t or "")
    assert len(found) == len(rows)
    for r in found:
        (text, *_) = texts[r.doc_id, r.size, r.text_crc32]
        places[text].add(r.shard)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(p) == 1 for p in places.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(sizes) <= set(range(shards))
    total, largest = sum(sizes.values()), max(len(t.encode()) + 8 for t in places)
    assert max(sizes.values()) <= max(total / shards * (1 + slack), largest)
    return sizes


def test_whole_table(spark):
    docs = read(spark, "sf0.01", "documents")
    sizes = check(pairs(docs), shard_documents(docs, 24).collect(), 24, 0.01)
    assert min(sizes.values()) > 0.97 * max(sizes.values())


def test_odd_rows(spark):
    check(ODD, shard_documents(table(spark, ODD), 3).collect(), 3, 2)
    assert shard_documents(table(spark, []), 24).count() == 0


def test_a_group_above_an_even_share_has_its_own_shard(spark):
    rows = [(i, "the same " * 30) for i in range(400)] + [(i, f"text number {i} " * 20) for i in range(400, 1200)]
    found = shard_documents(table(spark, rows), 8).collect()
    hot = {r.shard for r in found if r.doc_id < 400}
    assert len(hot) == 1 and not any(r.shard in hot for r in found if r.doc_id >= 400)
    sizes = defaultdict(int)
    for r in found:
        sizes[r.shard] += r.size
    rest = [v for s, v in sizes.items() if s not in hot]
    assert len(rest) == 7 and max(rest) < 1.02 * min(rest)


def test_same_result_twice(spark):
    docs = read(spark, "sf0.001", "documents")
    one = {tuple(r) for r in shard_documents(docs, 5).collect()}
    assert one == {tuple(r) for r in shard_documents(docs.repartition(9), 5).collect()}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 30)), max_size=120))
def test_tree_takes_the_tightest_room(steps):
    tree, held = RoomTree(), []
    for name, (put, size) in enumerate(steps):
        if put:
            tree.insert(size, name)
            held.append((size, name))
        else:
            want = min((e for e in held if e[0] >= size), default=None)
            assert tree.take(size) == want
            if want:
                held.remove(want)


def test_tree_stays_balanced():
    tree = RoomTree()
    for i in range(4096):
        tree.insert(i, i)
    assert tree.root[3] <= 18


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60), st.integers(1, 9))
def test_best_fit_decreasing(sizes, shards):
    sizes.sort(reverse=True)
    placed = _assign(sizes, shards)
    assert all(0 <= s < shards for s in placed)
    boxes, rooms = Boxes(100), []
    for size in sizes:
        fits = sorted((room, i) for i, room in enumerate(rooms) if room >= size)
        box = fits[0][1] if fits else len(rooms)
        if not fits:
            rooms.append(100)
        rooms[box] -= size
        got = boxes.put(size)
        assert rooms[got] >= 0 and boxes.count == len(rooms)
