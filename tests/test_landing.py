import json

import pytest

from playlake.schemas import BRONZE_DATA_DDL
from playlake.session import scratch_path
from playlake.sources.bronze import read_applist, read_bronze, write_bronze_lines
from playlake.sources.landing import (
    attempt_outcomes, fetch_outcomes, page_report, parsed_pages, unwrap_envelopes, unwrap_pages,
)
from pyspark.sql import functions as F


def landed(spark, rows):
    return spark.createDataFrame(rows, "requested_appid bigint, body string, fetched_at string, day string").select(
        "requested_appid", "body", "fetched_at", F.to_date("day").alias("snapshot_date")
    )


PAYLOAD = {"type": "demo", "name": 'Kite "Racer"', "about": {"text": "é, {braces}"}, "sizes": [1, 2.50, None], "is_free": True}


def test_the_whole_payload_comes_through(spark):  # L1, F19, K3
    text = json.dumps(PAYLOAD, ensure_ascii=False, separators=(",", ":"))
    body = '{"501":{"success":true,"data":' + text + "}}"
    rows = unwrap_envelopes(landed(spark, [(501, body, "2031-03-02T04:05:06", "2031-03-02")])).collect()
    assert [(r.appid, r.success, r.fetched_at) for r in rows] == [(501, True, "2031-03-02T04:05:06")]
    assert json.loads(rows[0].data) == PAYLOAD
    root = scratch_path(spark, "t_payload")
    bronze = unwrap_envelopes(landed(spark, [(501, body, "2031-03-02T04:05:06", "2031-03-02")]))
    assert write_bronze_lines(bronze.withColumn("snapshot_date", F.to_date(F.lit("2031-03-02"))), root) == 1
    stored = json.loads(spark.read.text(root).first().value)
    assert stored == {"appid": 501, "success": True, "fetched_at": "2031-03-02T04:05:06", "data": PAYLOAD}
    row = read_bronze(spark, root).first()  # the silver fields are read from the same line
    assert (row.appid, row.data.name, row.data.is_free) == (501, 'Kite "Racer"', True)
    assert spark.createDataFrame([], BRONZE_DATA_DDL).columns[0] == "type"


ATTEMPTS = [
    (601, json.dumps({"601": {"success": True, "data": {"name": "Harbor"}}}), "t1", "2031-01-01"),
    (602, json.dumps({"602": {"success": False}}), "t2", "2031-01-01"),
    (603, json.dumps({"999": {"success": True, "data": {}}}), "t3", "2031-01-01"),  # another id
    (604, '{"604": {"success": true, "da', "t4", "2031-01-02"),  # cut short
    (605, "", "t5", "2031-01-02"),
    (606, None, "t6", "2031-01-02"),
    (607, json.dumps({"607": {}}), "t7", "2031-01-02"),
    (608, json.dumps({"608": {"success": True}}), "t8", "2031-01-03"),
]


def test_failed_and_misaddressed_bodies_give_no_row(spark):  # L1, P12
    assert sorted(r.appid for r in unwrap_envelopes(landed(spark, ATTEMPTS)).collect()) == [601, 608]
    every = unwrap_envelopes(landed(spark, ATTEMPTS), requested_col=None).collect()
    assert sorted(r.appid for r in every) == [601, 608, 999]


def test_outcomes_count_every_attempt(spark):  # L3, K11, A12
    got = sorted(tuple(r) for r in fetch_outcomes(attempt_outcomes(landed(spark, ATTEMPTS))).collect())
    assert [(str(d), ok, err, n) for d, ok, err, n in got] == [
        ("2031-01-01", 1, 2, 3), ("2031-01-02", 0, 4, 4), ("2031-01-03", 1, 0, 1)]
    ready = spark.createDataFrame([("a", True), ("a", False), ("a", None)], "snapshot_date string, success boolean")
    assert [tuple(r) for r in fetch_outcomes(ready).collect()] == [("a", 1, 2, 3)]


def page(ids, more=None, last=None):
    response = {"apps": [{"appid": i, "name": f"item {i}"} for i in ids]}
    if more is not None:
        response["have_more_results"] = more
    if last is not None:
        response["last_appid"] = last
    return json.dumps({"response": response})


def pages(spark, rows):
    return spark.createDataFrame(rows, "taken string, page_no bigint, body string")


def ids(df):
    return sorted((r.taken, r.appid) for r in df.collect())


def test_each_snapshot_has_its_own_last_page(spark):  # L2, U5
    rows = [("a", 0, page([70, 71], True)), ("a", 1, page([72], False))]
    rows += [("b", n, page([80 + n], True)) for n in range(3)] + [("b", 3, page([83]))]
    want = [("a", 70), ("a", 71), ("a", 72), ("b", 80), ("b", 81), ("b", 82), ("b", 83)]
    assert ids(unwrap_pages(pages(spark, rows), "taken")) == want


def test_empty_pages(spark):  # F20
    assert unwrap_pages(pages(spark, [("a", 0, page([]))]), "taken").count() == 0
    assert unwrap_pages(pages(spark, [("a", 0, '{"response": {}}')]), "taken").count() == 0
    assert unwrap_pages(pages(spark, [("a", 0, "{}")]), "taken").count() == 0
    assert unwrap_pages(pages(spark, []), "taken").count() == 0


@pytest.mark.parametrize("rows, problem", [
    ([(0, page([1], True)[:-9]), (1, page([2], False))], "does not parse"),
    ([(0, None), (1, page([2], False))], "does not parse"),
    ([(0, page([1], True)), (2, page([3], False))], "gap"),
    ([(1, page([1], True)), (2, page([3], False))], "gap"),
    ([(0, page([1], True)), (1, page([2], True))], "last page is missing"),
    ([(0, page([1], False)), (1, page([2], False))], "follow the last page"),
])
def test_broken_snapshots_fail_loudly(spark, rows, problem):
    bad = pages(spark, [("x", n, b) for n, b in rows] + [("ok", 0, page([9], False))])
    with pytest.raises(Exception, match=problem):
        unwrap_pages(bad, "taken").collect()
    report = {r.taken: r.problem for r in page_report(parsed_pages(bad, "taken"), "taken").collect()}
    assert report["ok"] is None and problem in report["x"]
    assert ("ok", 9) in ids(unwrap_pages(bad, "taken", strict=False))


def test_applist_shapes_may_mix(spark, write_jsonl):  # S4
    nested = {"applist": {"apps": [{"appid": 31, "name": "n"}, {"appid": 32, "name": "m"}]}}
    flat = {"appid": 33, "name": "f", "last_modified": 5}
    root = write_jsonl("both/a.jsonl.gz", [nested, flat])
    write_jsonl("both/b.jsonl.gz", [{"applist": {"apps": []}}, {"appid": 34, "name": "g"}])
    rows = read_applist(spark, f"{root}/both").collect()
    assert sorted((r.appid, r.name, r.last_modified) for r in rows) == [
        (31, "n", None), (32, "m", None), (33, "f", 5), (34, "g", None)]


def cursor_pages(spark, rows):
    """Landed pages (snapshot, after, app ids, next cursor)."""
    def body(ids, last):
        return json.dumps({"response": {"apps": [{"appid": i} for i in ids], "have_more_results": last is not None, "last_appid": last}})

    return spark.createDataFrame([(s, after, body(ids, last)) for s, after, ids, last in rows], "snapshot int, after bigint, body string")


def test_pages_without_numbers_are_ordered_by_cursor(spark):
    import random

    from playlake.sources.landing import numbered_pages

    rows = [(s, 10 * p or None, [10 * p + 1, 10 * p + 10], 10 * (p + 1) if p < n - 1 else None) for s, n in ((1, 1), (2, 37), (None, 3)) for p in range(n)]
    shuffled = rows + rows[::5]
    random.Random(1).shuffle(shuffled)
    numbered = numbered_pages(cursor_pages(spark, shuffled), "snapshot")
    got = sorted((str(r.snapshot), r.page_no, r.appid) for r in unwrap_pages(numbered, "snapshot").collect())
    assert got == sorted((str(s), (a or 0) // 10, i) for s, a, ids, _ in rows for i in ids)


def test_broken_cursors_are_named(spark):
    from playlake.sources.landing import numbered_pages, page_chain

    rows = [
        (1, None, [1], 1), (1, 1, [2], 2), (1, 5, [6], 6), (1, 6, [7], None),  # the page that ends at 5 is missing
        (2, None, [1], 1), (2, 1, [2], 2), (2, 1, [3], 3), (2, 2, [9], None),  # two pages follow cursor 1
        (3, None, [1], 1), (3, 2, [1], 3), (3, 3, [2], 2),  # 2 and 3 lead round
        (4, 0, [1], None),
        (5, None, [1], 7), (5, 3, [2], 7), (5, 7, [3], None),
    ]
    landed = cursor_pages(spark, rows)
    got = {(r.snapshot, r.after): r.problem or r.page_no for r in page_chain(landed, "snapshot").collect()}
    assert got == {
        (1, 0): 0, (1, 1): 1, (1, 5): "no page ends at cursor 5", (1, 6): "no page ends at cursor 5",
        (2, 0): 0, (2, 1): "several pages follow cursor 1", (2, 2): "several pages follow cursor 1",
        (3, 0): 0, (3, 2): "cursors lead round at 2", (3, 3): "cursors lead round at 3",
        (4, 0): 0, (5, 0): 0, (5, 3): "no page ends at cursor 3", (5, 7): "several pages end at cursor 7",
    }
    with pytest.raises(Exception, match="catalogue snapshot"):
        numbered_pages(landed, "snapshot").collect()
    kept = numbered_pages(landed, "snapshot", strict=False).collect()
    assert {(r.snapshot, r.page_no) for r in kept} == {(1, 0), (1, 1), (2, 0), (3, 0), (4, 0), (5, 0)}
    assert page_chain(cursor_pages(spark, []), "snapshot").count() == 0
