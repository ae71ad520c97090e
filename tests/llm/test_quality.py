"""Quality classifier: features, held-out accuracy, folds, missing labels."""

import zlib

import numpy as np
from corpus_rows import ODD, read, table

from playlake.llm import quality
from playlake.llm.quality import BUCKETS, REPEAT, QualityModel, document_features, fit, keep_quality, score, score_text, train


def test_features_are_those_of_each_word():
    whole, _ = document_features(b"one two  three\ntwo")
    parts = [document_features(w)[0] for w in (b"one", b"two", b"three")]
    assert set(whole) == set(np.concatenate(parts))
    assert REPEAT in document_features(b"la la")[0] and REPEAT not in document_features(b"la lo")[0]
    ids, share = document_features(b"a b c a b")
    assert abs(share.sum() - 1) < 1e-5 and ids.max() <= BUCKETS
    assert len(document_features(b" \n ")[0]) == 0


def test_pieces_do_not_change_a_score(monkeypatch):
    rng = np.random.default_rng(1)
    model = QualityModel(rng.normal(size=BUCKETS + 1).astype(np.float32), 0.3)
    text = " ".join(f"word{i % 53}" for i in range(4000)).encode()
    whole = score_text(text, model)
    monkeypatch.setattr(quality, "PIECE", 1000)
    assert abs(score_text(text, model) - whole) < 1e-4


def test_held_out_accuracy(spark):
    docs, labels = read(spark, "sf0.01", "documents"), read(spark, "sf0.01", "labels")
    found = {r.doc_id: r for r in score(docs, train(docs, labels)).collect()}
    assert len(found) == docs.count()
    marks = [(found[r.doc_id], r.quality) for r in labels.collect()]
    assert all(f.held_out == (zlib.crc32(str(f.doc_id).encode()) % 5 == 0) for f in found.values())
    held = [(f.score, q) for f, q in marks if f.held_out]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert good and bad and all(0 <= s <= 1 for s in good + bad)
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert np.mean([s >= 0.3 for s in good]) > 0.95


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = read(spark, "sf0.001", "documents"), read(spark, "sf0.001", "labels")
    other = labels.selectExpr(
        "doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) quality", "toxic"
    )
    one, two = train(docs, labels), train(docs, other)
    assert one.bias == two.bias and (one.weights == two.weights).all()


def test_no_labels_one_label_and_odd_rows(spark):
    docs = table(spark, ODD)
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    model = train(docs, none)
    rows = score(docs, model).collect()
    assert len(rows) == len(ODD) and all(r.score == 0.5 and r.predicted == 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    alike = fit([document_features(b"a")] * 3, np.zeros(3, np.int64))
    assert score_text(b"", alike) < 0.3 and keep_quality(docs, alike).count() == 0
    assert keep_quality(docs, model).columns == docs.columns
    assert score(table(spark, []), model).count() == 0
    assert train(table(spark, []), none).bias == 0.0


def test_repeated_labels_and_clashing_columns(spark):
    docs = table(spark, [(i, "good text here" if i % 2 else "!! !! !!") for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(200)] * 2, "doc_id long, quality int, toxic int, score string")
    kept = {r.doc_id for r in keep_quality(docs, train(docs, labels)).collect()}
    assert kept == {i for i in range(200) if i % 2}


def test_a_labelled_id_that_repeats_is_learned_from_once(spark):
    docs, labels = read(spark, "sf0.001", "documents"), read(spark, "sf0.001", "labels")
    one = docs.join(labels, "doc_id").where("doc_id % 7 = 3").select(docs.columns).limit(1)
    many = docs.unionByName(one.selectExpr("explode(array_repeat(struct(*), 3000)) AS r").select("r.*"))
    plain, again = train(docs, labels), train(many.repartition(6), labels)
    assert plain.bias == again.bias and (plain.weights == again.weights).all()
