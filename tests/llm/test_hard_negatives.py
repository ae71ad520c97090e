"""Strassen products against plain ones; mined rows against brute force with Python integers."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from playlake.llm.hard_negatives import Heaps, mine_hard_negatives, share, strassen
from playlake.llm.queries import op13_hard_negatives

TYPE = "vec_id long, embedding array<double>, label int, key string, score string, slot string, v string"


def plain(rows, every=50, positives=5, negatives=3, window=(50, 95), scale=256):
    part = []
    for i, v, label in rows:
        if v is None or label is None or any(x is None or not math.isfinite(x) or not math.isfinite(scale * x) for x in v):
            continue
        q = [math.floor(scale * x) for x in v]
        if sum(x * x for x in q) < 1 << 62:
            part.append((i, q, label))
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for a, (i, q, label) in enumerate(part):
        if i is None or i % every:
            continue
        scores = [(sum(x * y for x, y in zip(q, p[1], strict=False)), p[0], p[2]) for b, p in enumerate(part) if b != a]
        for score, pos, _ in sorted((s for s in scores if s[2] == label), key=order)[:positives]:
            fit = [s for s in scores if s[2] != label and window[0] * score <= 100 * s[0] <= window[1] * score]
            out += [(i, pos, r, n[1], score, n[0]) for r, n in enumerate(sorted(fit, key=order)[:negatives], 1)]
    return sorted(out, key=str)


def found(df, **options):
    got = mine_hard_negatives(df, **options)
    assert got.dtypes[2] == ("rank", "int")
    return sorted((tuple(r) for r in got.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, g, "k", None, "s", "v") for i, v, g in rows], TYPE)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 40), st.integers(1, 40), st.integers(1, 9), st.integers(0, 2**32 - 1))
def test_strassen(m, k, n, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(1 << 30), 1 << 30, (m, k)), rng.integers(-(1 << 30), 1 << 30, (k, n))
    assert (strassen(a, b, leaf) == a.astype(object) @ b.astype(object)).all()


def test_strassen_is_exact_where_its_sums_run_over():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(1 << 31) + 1, 1 << 31, (64, 64)), np.eye(64, dtype=np.int64) * ((1 << 31) - 1)
    assert (strassen(a, b, 2) == a * ((1 << 31) - 1)).all()
    assert strassen(np.empty((3, 0), np.int64), np.empty((0, 5), np.int64)).tolist() == [[0] * 5] * 3


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-3, 3), st.booleans(), st.integers(0, 4)), max_size=60), st.integers(1, 4))
def test_heaps_merge_in_any_order(rows, size):
    want = []
    for slot in range(4):
        want += sorted((r for r in rows if r[0] == slot), key=lambda r: (-r[1], r[2], r[3]))[:size]
    heaps = Heaps(4, size)
    for at in range(0, len(rows), 7):
        part = rows[at : at + 7]
        heaps.push(*(np.array(c, t) for c, t in zip(zip(*part, strict=True), (int, int, bool, int), strict=True)))
    assert [tuple(x) for x in zip(*(c.tolist() for c in heaps.rows), strict=True)] == want


def test_shares_round_down_without_overflow(spark):
    scores = [0, 1, -1, 99, 101, -101, (1 << 62) - 1, -(1 << 62) + 1]
    df = spark.createDataFrame([(s,) for s in scores], "s long").select("s", share(F.col("s"), 95), -share(-F.col("s"), 50))
    assert [tuple(r) for r in df.collect()] == [(s, s * 95 // 100, -(-s * 50 // 100)) for s in scores]


@pytest.mark.parametrize("anchors_every", [1, 7])
def test_against_brute_force(spark, anchors_every):
    """Ties, repeated rows and ids, null ids, vectors of other lengths, and rows that take no part."""
    rng = random.Random(anchors_every)
    rows = []
    for i in range(150):
        width = rng.choice((7, 7, 7, 5, 9, 0))
        v = [rng.choice((0.5, 0.25, -0.25, rng.random())) for _ in range(width)]
        rows.append((rng.choice((i, i, i % 40, None)), v, rng.choice((0, 1, 2))))
    rows += rng.sample(rows, 30)
    rows += [(0, None, 1), (1, [1.0] * 7, None), (2, [1.0, None], 1), (3, [math.nan], 1), (4, [math.inf], 1), (5, [1e306], 1)]
    rows += [(6, [1e8] * 7, 1), (8, [1e6, -1e6], 1), (9, [8e6, 1.0], 2), (10, [7e6, 2.0], 0)]
    options = {"every": anchors_every, "window": (50, 95)}
    got = found(frame(spark, rows).repartition(5), **options)
    assert got == plain(rows, **options) and got


def test_no_rows_and_no_anchors(spark):
    assert found(frame(spark, [])) == []
    assert found(frame(spark, [(1, [1.0], 1), (None, [1.0], 1), (50, [1.0], 2), (51, None, 2)])) == []


def test_a_vector_that_a_third_of_all_rows_share(spark):
    rng = random.Random(9)
    base = [rng.random() for _ in range(16)]
    rows = [(i, base if i % 3 == 0 else [rng.random() for _ in range(16)], 1 if i % 3 == 0 else rng.randrange(4)) for i in range(900)]
    assert found(frame(spark, rows).repartition(9)) == plain(rows)


def test_the_query_moves_labels(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, [rng.random() for _ in range(8)], rng.randrange(10)) for i in range(300)]
    path = str(tmp_path / "embeddings.parquet")
    frame(spark, rows).select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"), "label").write.parquet(path)
    moved = [(i, [float(np.float32(x)) for x in v], (g + 1) % 10 if i % 7 == 0 else g) for i, v, g in rows]
    got = sorted((tuple(r) for r in op13_hard_negatives(spark, str(tmp_path)).collect()), key=str)
    assert got == plain(moved)
