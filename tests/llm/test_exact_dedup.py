"""Exact dedup against a dictionary of normalised texts, also when every hash collides."""

import hashlib

import pytest
from corpus_rows import CLASHING, ODD, pairs, read, table

from playlake.llm.exact_dedup import BLANKS, drop_exact_copies, exact_groups


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate({ord(c): None for c in BLANKS}), []).append((i, t or ""))
    out = []
    for plain, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        sha = hashlib.sha256(plain.encode()).hexdigest()
        out += [(i, keep, len(members), i == keep, sha) for i, _ in members]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.sha).hex()) for r in df.collect()), key=str)


def test_odd_rows(spark):
    assert got(exact_groups(table(spark, ODD))) == expected(ODD)


def test_whole_table(spark):
    docs = read(spark, "sf0.001", "documents")
    assert got(exact_groups(docs)) == expected(pairs(docs))


@pytest.mark.parametrize("weak", [lambda t: b"", lambda t: t[:1]])
def test_colliding_hashes_are_told_apart_by_their_bytes(spark, weak):
    assert got(exact_groups(table(spark, ODD), weak)) == expected(ODD)


def test_empty_table(spark):
    assert got(exact_groups(table(spark, []))) == []
    assert drop_exact_copies(table(spark, [])).count() == 0


def test_one_row_of_each_group_stays_with_its_columns(spark):
    docs = table(spark, ODD)
    left = drop_exact_copies(docs)
    assert left.columns == docs.columns and set(CLASHING) < set(left.columns)
    rows = pairs(left)
    texts = [(t or "").translate({ord(c): None for c in BLANKS}) for _, t in rows]
    assert len(texts) == len(set(texts)) == 5
    assert (2, ODD[1][1]) in rows  # the longer original
    assert (9, "x") in rows and (5, " \n\t ") in rows and (6, ODD[5][1]) in rows


def test_an_id_shared_by_different_texts(spark):
    rows = [(1, "a b"), (1, "ab"), (1, "c"), (2, "c"), (3, "d"), (3, "d")]
    left = sorted(pairs(drop_exact_copies(table(spark, rows))))
    assert [t.replace(" ", "") for _, t in left] == ["ab", "c", "d"]


def test_hot_group(spark):
    rows = [(i, "same text in a third of the rows") for i in range(3000)] + [(i, f"text {i}") for i in range(3000, 9000)]
    left = drop_exact_copies(table(spark, rows))
    assert left.count() == 6001 and left.agg({"doc_id": "min"}).first()[0] == 0


def test_rows_without_id_meet_their_own_hash_only(spark):
    """600 rows without id in 300 pairs: as many texts are compared, and no hash is taken for collided."""
    from playlake.llm import exact_dedup

    docs = table(spark, [(None, f"text number {i // 2}") for i in range(600)]).repartition(5)
    narrow = docs.select("doc_id", "text").selectExpr("cast(doc_id AS long) doc_id", "unhex(md5(replace(text, ' ', ''))) AS h")
    assert exact_dedup._collided(docs, narrow, exact_dedup.content_hash).count() == 0
    assert sorted({r.group_size for r in exact_dedup.exact_groups(docs).collect()}) == [2]
