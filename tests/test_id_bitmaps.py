"""Id sets as bitmaps against plain sets."""

import random

from playlake.operators.id_bitmaps import BITS, bitmap_ids, id_bitmaps, merged_bitmaps, not_in_bitmaps


def frame(spark, ids):
    return spark.createDataFrame([(i, "x") for i in ids], "appid bigint, bitmap string")


def ids_of(df):
    return sorted(r.appid for r in df.collect())


def test_sets_round_trip(spark):
    rng = random.Random(1)
    ids = [1, 2, BITS, BITS + 1, 0, -1, -BITS, -BITS - 1, 3_000_000, 1 << 40, *(rng.randrange(1, 200_000) for _ in range(500))]
    sets = id_bitmaps(frame(spark, ids + ids + [None]).repartition(5))
    assert ids_of(bitmap_ids(sets)) == sorted(set(ids))
    assert sets.count() == len({(i - 1) // BITS + 1 if i > 0 else -(-i // BITS) for i in ids})


def test_union_and_anti_join(spark):
    rng = random.Random(2)
    a, b = ([rng.randrange(-50, 100_000) for _ in range(3000)] for _ in range(2))
    known = merged_bitmaps(id_bitmaps(frame(spark, a)), id_bitmaps(frame(spark, b)))
    assert ids_of(bitmap_ids(known)) == sorted(set(a + b))
    asked = [rng.randrange(-60, 300_000) for _ in range(4000)] + a[:200]
    left = not_in_bitmaps(frame(spark, asked + [None]), known)
    assert left.columns == ["appid", "bitmap"]
    got = [r.appid for r in left.collect()]
    assert got.count(None) == 1
    assert sorted(i for i in got if i is not None) == sorted(i for i in asked if i not in set(a + b))


def test_empty_sets(spark):
    none = id_bitmaps(frame(spark, []))
    assert none.count() == 0 and bitmap_ids(none).count() == 0
    assert ids_of(not_in_bitmaps(frame(spark, [3, 3]), none)) == [3, 3]
    assert not_in_bitmaps(frame(spark, []), id_bitmaps(frame(spark, [1]))).count() == 0


def test_a_hot_id_is_a_bit_before_the_shuffle(spark):
    sets = id_bitmaps(spark.range(50_000).selectExpr("if(id % 3 = 0, 7, id) AS appid"))
    assert "partial_bitmap_construct_agg" in sets._jdf.queryExecution().executedPlan().toString()
    assert sets.count() == 2  # 1 to 32768, and above
