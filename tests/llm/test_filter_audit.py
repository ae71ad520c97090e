"""Filter audit against a plain simulation of every order; packed counters against plain ones."""

import random
from collections import Counter
from itertools import permutations

import pytest
from corpus_rows import LONG, ODD, read
from hypothesis import given, settings, strategies as st

from playlake.llm.filter_audit import AUDIT, FIELD_BITS, MEASURES, ORDERS, STEPS, audit_filters, fields, mask_of, outcomes

NAMES = AUDIT.replace(",", "").split()[::2]


def plain_fails(text):
    words = [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]
    return {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
        "D": any(c in "#$%&*|" for c in text),
    }


def plain(rows, labels):
    """The audit of (doc_id, text, lang) rows, document by document."""
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, x in labels if x == 1}
    docs = []
    for d, t, lang in rows:
        fails = plain_fails(t or "") | {"E": d is not None and d > least[t or ""]}
        docs.append((lang or "", fails, d is not None and d in good, d is not None and d in toxic))
    out = {}
    for part in {p for p, *_ in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, x in enumerate(order, 1):
                removed = [d for d in left if d[1][x]]
                left = [d for d in left if not d[1][x]]
                fail = [d for d in mine if d[1][x]]
                out[part, order, step] = [
                    len(left), len(removed), len(fail) - len(removed), sum(sum(d[1].values()) == 1 for d in fail),
                    sum(d[2] for d in removed), sum(d[3] for d in removed)]
        for x in "ABCDE":
            mine_at = [(o, o.index(x) + 1) for o in ORDERS]
            total = sum(out[part, o, s][1] for o, s in mine_at)
            for o, s in mine_at:
                out[part, o, s].append(total)
    return {k: tuple(v) for k, v in out.items()}


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(d, t, g, None, 1) for d, t, g in rows], "doc_id long, text string, lang string, part string, mask int")
    return docs, spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, good string")


def found(docs, labels):
    got = [tuple(r) for r in audit_filters(docs, labels).select(NAMES).collect()]
    assert len({r[:3] for r in got}) == len(got)
    return {r[:3]: r[3:] for r in got}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="Aab \t\n\x0b\x0c\r\x1c  é漢#|", max_size=150))
def test_masks(text):
    fails = plain_fails(text)
    assert mask_of(text.encode()) == sum(fails[x] << i for i, x in enumerate("ABCD"))


def test_thresholds():
    words = [f"w{i}" for i in range(100)]
    assert mask_of(" ".join(words).encode()) == 0
    assert mask_of(" ".join(words[:99]).encode()) == 1
    assert mask_of(" ".join(words[:80] + ["w0"] * 20).encode()) == 0
    assert mask_of(" ".join(words[:79] + ["w0"] * 21).encode()) == 2
    assert mask_of(("A" * 10 + "é" * 90).encode()) == 1
    assert mask_of(("A" * 11 + "é" * 89).encode()) == 5
    assert mask_of(LONG.encode()) == 2


def test_packed_sums_equal_plain_sums_and_never_run_over():
    rng = random.Random(1)
    for counts in ([rng.randrange(1 << 40) for _ in range(32)], [(1 << 58) - 1] * 32, [0] * 32):
        total = fields(sum(n * outcomes(m) for m, n in enumerate(counts)))
        want = [[0] * STEPS for _ in MEASURES]
        for m, n in enumerate(counts):
            for i, order in enumerate(ORDERS):
                gone = False
                for s, x in enumerate(order):
                    fail = bool(m >> "ABCDE".index(x) & 1)
                    marks = [not gone and not fail, not gone and fail, gone and fail, fail and m & (m - 1) == 0]
                    for k, mark in enumerate(marks):
                        want[k][i * 5 + s] += n * mark
                    gone |= fail
        assert total.tolist() == want
    assert FIELD_BITS == 64 and STEPS == 600


def test_against_the_simulation(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(60):
        words = [f"w{rng.randrange(rng.choice((30, 4000)))}" for _ in range(rng.choice((20, 110, 130)))]
        text = " ".join(words)
        texts.append(rng.choice((text, text.upper(), text + " #", text + " é|")))
    rows = [(rng.choice((i, i, i % 90)), rng.choice(texts + [None, ""]), rng.choice(("en", "de", None, ""))) for i in range(400)]
    rows += [(None, rng.choice(texts), "en") for _ in range(40)]
    labels = [(rng.randrange(420), rng.randrange(2), rng.randrange(2)) for _ in range(300)] + [(None, 1, 1), (3, None, None)]
    docs, marks = frames(spark, rows, labels)
    assert found(docs.repartition(6), marks) == plain(rows, labels)


def test_odd_rows(spark):
    rows = [(d, t, None) for d, t in ODD]
    docs, marks = frames(spark, rows, [(1, 1, 0), (9, 0, 1), (9, 1, 1)])
    assert found(docs, marks) == plain(rows, [(1, 1, 0), (9, 0, 1), (9, 1, 1)])


def test_empty_tables(spark):
    docs, marks = frames(spark, [], [])
    assert found(docs, marks) == {}
    docs, marks = frames(spark, [(1, "x", "en")], [])
    assert found(docs, marks) == plain([(1, "x", "en")], [])


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_whole_table(spark, sf):
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert found(docs, labels) == plain(rows, [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])


def test_a_hot_text_is_a_few_rows_a_task(spark):
    rows = [(i, "one text everywhere", "en") for i in range(3000)]
    docs, marks = frames(spark, rows, [])
    got = found(docs.repartition(8), marks)
    assert got["en", "EABCD", 1][:3] == (1, 2999, 0) and got["en", "AEBCD", 2][:3] == (0, 0, 2999)
    assert Counter(k[0] for k in got) == {"en": 600}
