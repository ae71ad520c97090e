"""License scan against phrases counted word by word, and notices with planted edits."""

import random
import re

from corpus_rows import ODD, pairs, read, table
from hypothesis import given, settings, strategies as st

from playlake.llm.licenses import NOTICES, PHRASES, WORD_BYTES, Scanner, license_digest, scan_licenses, seeds


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base(text):
    words, found = words_of(text), []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    places = [i for i, _ in found]
    return (
        len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))
    )


def check(spark, docs, rows):
    got = sorted(
        ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_digest(scan_licenses(docs)).collect()),
        key=str,
    )
    assert got == sorted(((i, *base(t)) for i, t in rows), key=str)


def test_whole_table(spark):
    docs = read(spark, "sf0.01", "documents")
    check(spark, docs, pairs(docs))


def test_odd_rows(spark):
    rows = [*ODD, (20, "MIT License mit license\tMIT-LICENSE! permit license"), (21, "the Apache\nLicense; general public license")]
    check(spark, table(spark, rows), rows)
    found = {r.doc_id: r for r in license_digest(scan_licenses(table(spark, rows))).collect()}
    assert found[20].labels == "mit" and found[21].labels == "apache,gpl" and found[20].score == 1.0
    assert found[3].labels == "" and found[3].score == 0.0
    assert scan_licenses(table(spark, [])).count() == 0


def test_notices_with_edits_are_found_and_others_not(spark):
    rng, rows, labels = random.Random(4), [], {}
    for n, (notice, label, edits) in enumerate(NOTICES):
        text = list(notice)
        for at in rng.sample(range(1, len(text) - 1), edits):
            if text[at] != " ":
                text[at] = "q"
        rows.append((n, f"Some words before {''.join(text)} and after"))
        labels[n] = label
    rows.append((100, "a plain text about licences and the public, general interest, and copies of it"))
    found = {r.doc_id: r for r in license_digest(scan_licenses(table(spark, rows))).collect()}
    for n, label in labels.items():
        assert label in found[n].labels.split(","), NOTICES[n]
        assert 0 < found[n].score <= 1
    assert found[100].labels == ""


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_a_match_within_the_edits_holds_a_seed(data):
    notice, _, edits = data.draw(st.sampled_from(NOTICES))
    text = notice
    for _ in range(edits):
        at = data.draw(st.integers(0, len(text) - 1))
        text = text[:at] + data.draw(st.sampled_from(["", "z", "zz"])) + text[at + 1 :]
    assert any(seed in text for _, seed in seeds(notice, 2 * edits))  # a two-letter edit counts twice


def test_spans_lie_where_the_notice_is():
    plain = "one two released under the mit licence three"
    (span,) = [s for s in Scanner().spans(plain) if s[0] == "mit" and s[3] <= 1 and s[2] - s[1] > 20]
    assert plain[span[1] : span[2]] == "released under the mit licence" and span[4] > 0.9
    assert len(WORD_BYTES) == 256


def test_neighbouring_notices_with_different_edits():
    for first, second, gap in (
        ("the mit licens", "the mit license", " "),
        ("released under the mit licence", "released under the mit license", " foo "),
        ("gnu general public licence", "gnu general public license", " v2 "),
    ):
        for parts in ((first, second), (second, first), (first, second, first), (second, first, first, second)):
            plain = gap.join(parts)
            found = {plain[a:b] for _, a, b, _, _ in Scanner().spans(plain)}
            starts = {a for _, a, b, _, _ in Scanner().spans(plain) if b - a >= len(first)}
            assert set(parts) <= found
            assert starts >= {sum(len(p) + len(gap) for p in parts[:i]) for i in range(len(parts))}


def test_a_dense_text_is_counted_once():
    import time

    plain = b"mit license x " * 60_000
    began = time.monotonic()
    found = Scanner().exact_places(plain)
    assert time.monotonic() - began < 2
    assert [n for n, _ in found] == list(range(0, 180_000, 3))
