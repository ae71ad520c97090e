"""N-gram Jaccard join against all pairs of small tables."""

import random

import numpy as np
import pytest
from corpus_rows import LONG, ODD, pairs, read, table
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from playlake.llm.jaccard_join import jaccard_components, least_distance, overlap_needed, prefix_length, shingles, signature


def plain_set(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def plain(rows, percent=90):
    """(doc_id, set size, smallest id reachable) of every row, by all pairs."""
    sets = [plain_set(t) for _, t in rows]
    roots = list(range(len(rows)))

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                roots[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def found(docs, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs, **options).collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + rng.choice((0, 1))] = [f"new{rng.randrange(10**6)}"] * rng.choice((0, 1, 1))
    return " ".join(words)


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aB \t\né", max_size=60))
def test_shingles(text):
    assert len(shingles(text.encode())) == len(plain_set(text))


def test_shingles_tell_order_and_number_apart():
    texts = [b"a b c", b"b a c", b"c b a", b"a b", b"a", b"a a", b"a a a", b"b a"]
    assert len({shingles(t).tobytes() for t in texts}) == len(texts)


def test_prefix_and_overlap():
    assert [prefix_length(n, 90) for n in (1, 9, 10, 11, 100)] == [1, 1, 2, 2, 11]
    for x in range(1, 60):
        for y in range(x, 60):
            least = next((o for o in range(x + 1) if 100 * o >= 90 * (x + y - o)), None)
            need = int(overlap_needed(np.array([x + y]), 90)[0])
            assert need == least if least is not None else need > x


def test_signatures_bound_the_distance():
    rng = np.random.default_rng(3)
    for n in (1, 5, 40, 300, 5000):
        one = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
        for share in (0, 0.02, 0.3, 1, 3):
            other = np.unique(np.concatenate((one[rng.random(len(one)) > share / 2], rng.integers(0, 1 << 64, int(n * share), np.uint64))))
            apart = len(np.setxor1d(one, other))
            least = least_distance(signature(one), signature(other))
            assert least <= apart and least == least_distance(signature(other), signature(one))
            assert least >= abs(len(one) - len(other)) and (n < 5000 or share > 0.1 or least > 0.5 * apart or not apart)
    assert least_distance(b"", signature(np.arange(9, dtype=np.uint64))) == 0


def test_odd_rows(spark):
    assert found(table(spark, ODD)) == plain(ODD)


def test_no_rows(spark):
    assert found(table(spark, [])) == []
    assert found(table(spark, [(1, None), (2, ""), (None, " ")])) == [(1, 0, 1), (2, 0, 2), (None, 0, None)]


def test_percent_is_checked(spark):
    with pytest.raises(ValueError):
        jaccard_components(table(spark, ODD), percent=0)


@pytest.mark.parametrize("piece", [4096, 3])
def test_clusters_of_every_distance(spark, piece):
    """Copies 0 to 8 edits from their base: links, chains of links and near misses; with pieces of
    three nodes every frequent token is dealt in pieces and its pieces meet."""
    rng = random.Random(piece)
    rows = []
    for size, copies in ((60, 40), (25, 25), (120, 12), (9, 12), (3, 4)):
        base = [f"w{rng.randrange(400)}" for _ in range(size)]
        rows += [edited(rng, base, rng.randrange(0, 9)) for _ in range(copies)]
    rows += [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    rng.shuffle(rows)
    rows = [(n * 3 % 1009, t) for n, t in enumerate(rows)]
    assert found(table(spark, rows).repartition(5), piece=piece) == plain(rows)


def test_other_thresholds(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(50)]
    rows = [(n, edited(rng, base, rng.randrange(0, 20))) for n in range(40)]
    for percent in (50, 80, 100):
        assert found(table(spark, rows), percent=percent) == plain(rows, percent)


def test_hot_copies_and_near_copies(spark):
    """Half of all rows are one text, a third near copies of another: one component each."""
    base = [f"b{i}" for i in range(100)]
    rows = [(i, "the same text in a great many rows of this table") for i in range(600)]
    rows += [(1000 + i, " ".join([*base[:50], f"only{i}", *base[50:]])) for i in range(400)]
    rows += [(5000, " ".join(base)), (5001, LONG), (5002, LONG + " end")]
    got = {d: c for d, _, c in found(table(spark, rows).repartition(7), piece=64)}
    assert {got[i] for i in range(600)} == {0}
    assert {got[1000 + i] for i in range(400)} | {got[5000]} == {1000}
    assert got[5001] == got[5002] == 5001


def test_whole_table(spark):
    docs = read(spark, "sf0.01", "documents")
    assert found(docs) == plain(pairs(docs))
    assert "doc_id" in jaccard_components(docs.withColumn("node", F.lit(1))).columns
