"""Packing: an exact round trip of every id, the three limits, and tokenisation word by word."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpus_rows import ODD, pairs, read, table
from hypothesis import given, settings, strategies as st

from playlake.llm.packing import END, Packer, pack, tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return [*tokenizer(PATH).whole.encode(text or "", add_special_tokens=False).ids, END]


def check(rows, pieces, limit=4096, segments=256):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id, p.doc_tokens].append(p)
        by_sequence[p.sequence_id].append(p)
    lengths = defaultdict(int)
    for i, text in rows:
        lengths[i, len(ids_of(text))] += 1
    for (i, n), copies in lengths.items():
        assert sum(p.length for p in by_doc[i, n]) == n * copies
    assert sum(p.length for p in pieces) == sum(n * c for (_, n), c in lengths.items())
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= limit and (at == limit or at & (at - 1) == 0) and len(parts) <= segments


def test_round_trip(spark):
    docs = read(spark, "sf0.001", "documents")
    pieces = pack(docs, PATH).collect()
    rows = pairs(docs)
    check(rows, pieces)
    ids = {i: ids_of(t) for i, t in rows}
    seen = defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == seen[p.doc_id]  # each id in exactly one piece
        seen[p.doc_id] += p.length
        part = np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes()
        assert p.ids_crc32 == zlib.crc32(part)
    assert all(seen[i] == len(x) for i, x in ids.items())


def test_odd_rows_and_small_limits(spark):
    check(ODD, pack(table(spark, ODD), PATH).collect())
    check(ODD, pack(table(spark, ODD), PATH, max_tokens=64, max_segments=3, max_loss=64).collect(), 64, 3)
    assert pack(table(spark, []), PATH).count() == 0


ODD_WORDS = "Don't STOP'll 12.5%'s ÉÀß×÷ ²½ ﬁ Σας ΑΣ éa <|endoftext|> x<|startoftext|>y \x1c z '''s a'S 漢字 İ ǅ  q r"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aZé's1.!ß ×\ń", max_size=30))
def test_words_tokenise_as_the_whole_text(text):
    for t in (text, ODD_WORDS):
        ids = np.frombuffer(tokenizer(PATH).ids(t.encode()), "<u4").tolist()
        assert [*ids, END] == ids_of(t)


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.tuples(st.integers(1, 90), st.integers(0, 90)), max_size=40),
    st.integers(8, 40), st.integers(1, 5), st.integers(4, 40), st.integers(1, 8),
)
def test_packer_keeps_all_three_limits(docs, tokens, segments, loss, waiting):
    packer = Packer(tokens, segments, loss, waiting)
    for i, (n, masked) in enumerate(docs):
        packer.add(i, np.full(n, i, "<u4").tobytes(), masked)
    packer.finish()
    done, sums = defaultdict(int), defaultdict(lambda: [0, 0, 0])
    for e, start, length, sequence, offset in packer.pieces:
        assert start == done[e.doc_id] and offset == sums[sequence][0]
        done[e.doc_id] += length
        masked = docs[e.doc_id][1]
        for k, v in enumerate((length, 1, sum(start + j >= masked for j in range(length)))):
            sums[sequence][k] += v
    assert dict(done) == {i: n for i, (n, _) in enumerate(docs)}
    assert all(a <= tokens and b <= segments and c <= loss for a, b, c in sums.values())


def test_masked_column_and_bad_limits(spark):
    docs = table(spark, [(i, "some words to learn") for i in range(20)]).selectExpr("*", "if(doc_id < 10, 3, null) prompt")
    pieces = pack(docs, PATH, max_tokens=64, max_loss=8, masked="prompt").collect()
    assert sum(p.length for p in pieces) == 100
    with pytest.raises(ValueError):
        Packer(0, 1, 1)
