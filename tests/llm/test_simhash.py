"""SimHash near-dedup against bit-by-bit fingerprints and all pairs of a small table."""

import random

import numpy as np
import xxhash
from corpus_rows import LONG, ODD, pairs, read, table
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from playlake.llm.components import connected_components
from playlake.llm.simhash import block_masks, drop_near_copies, fingerprint, near_duplicates, near_links


def plain_fingerprint(text, width=4):
    words = text.encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids, bits):
    roots = list(range(len(prints)))

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                a, b = sorted((find(i), find(j)))
                roots[b] = a
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(prints))]


def check(spark, docs, rows, **options):
    found = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in near_duplicates(docs, **options).collect()), key=str)
    prints = [fingerprint((t or "").encode()) for _, t in rows]
    ids = [i for i, _ in rows]
    assert found == sorted(zip(ids, prints, plain_components(prints, ids, 4), strict=True), key=str)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB \t\né", max_size=80))
def test_fingerprint_bits(text):
    assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprint_of_a_long_text():
    assert fingerprint(LONG.encode()) == plain_fingerprint(LONG)


def test_fingerprint_agrees_with_the_engine_hash(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("some words in here"))).first()[0] % (1 << 64) == fingerprint(b"Some words IN here")


def test_every_close_pair_shares_a_mask():
    masks, rng = block_masks(7, 4), random.Random(3)
    for _ in range(500):
        flips = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not flips & m for m in masks)


def test_odd_rows(spark):
    check(spark, table(spark, ODD), ODD)


def test_whole_table(spark):
    docs = read(spark, "sf0.001", "documents")
    check(spark, docs, pairs(docs))


def test_empty_table(spark):
    assert near_duplicates(table(spark, [])).count() == 0
    assert drop_near_copies(table(spark, [])).count() == 0


def signed(values):
    return [int(v) for v in np.array(values, np.uint64).view(np.int64)]


def test_a_run_larger_than_a_task_is_compared_piece_by_piece(spark):
    rng = random.Random(5)
    base, prints = rng.getrandbits(64), set()
    while len(prints) < 300:  # a chain, so that links matter
        last = base
        base ^= 1 << rng.randrange(20) | 1 << rng.randrange(20)
        prints |= {last, base}
    prints |= {rng.getrandbits(64) for _ in range(50)}
    df = spark.createDataFrame([(x,) for x in signed(sorted(prints))], "fp long")
    for run in (16, 4096):
        labels = {r.node: r.component for r in connected_components(near_links(df, run=run)).collect()}
        values = signed(sorted(prints))
        roots = [labels.get(v, v) for v in values]
        unsigned = sorted(prints)
        want = plain_components(unsigned, values, 4)
        assert len(set(roots)) == len(set(want))
        assert len(set(zip(roots, want, strict=True))) == len(set(roots))


def test_components_of_chains_and_repeated_edges(spark):
    edges = [(i, i + 1) for i in range(60)] + [(70, 70), (80, 81), (81, 80), (80, 81), (None, 3)]
    labels = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert labels == {i: 0 for i in range(1, 61)} | {81: 80}


def test_one_document_of_each_component_stays(spark):
    docs = table(spark, ODD)
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 6, 8, 9]


def test_one_row_of_each_component_stays_whatever_the_ids(spark):
    base = [f"word{i}" for i in range(4000)]
    near = [" ".join([*base[:i], "other", *base[i + 1 :]]) for i in (10, 200, 390)] + [" ".join(base)]
    other = " ".join(f"else{i}" for i in range(400))
    for ids in ((None,) * 4, (7,) * 4, (7, 7, None, None), (3, 7, None, 3)):
        rows = [*zip(ids, near, strict=True), (None, other), (7, other), (7, other)]
        left = pairs(drop_near_copies(table(spark, rows).repartition(3)))
        assert sorted(t == other for _, t in left) == [False, True], ids
        assert all(i == min((x for x in ids if x is not None), default=None) for i, t in left if t != other)
        assert all(i == 7 for i, t in left if t == other)
