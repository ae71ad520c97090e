"""The corpus pipeline against its stages in plain Python, and on odd tables."""

import corpus_pipeline
from corpus_rows import ODD, read, table

from playlake.llm.decontamination import find_leaks
from playlake.llm.exact_dedup import exact_groups
from playlake.llm.packing import pack
from playlake.llm.quality import score, train
from playlake.llm.simhash import near_duplicates

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_follow_their_operators(spark):
    docs = read(spark, "sf0.001", "documents")
    labels, bench = read(spark, "sf0.001", "labels"), read(spark, "sf0.001", "benchmark")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF)
        assert left.columns == docs.columns
        rows = {r.doc_id for r in docs.collect()}
        if name == "quality":
            want = {r.doc_id for r in score(docs, train(docs, labels)).collect() if r.predicted == 1}
        elif name == "exact_dedup":
            want = {r.doc_id for r in exact_groups(docs).collect() if r.kept}
        elif name == "near_dedup":
            want = {r.component_id for r in near_duplicates(docs).collect()}
        else:
            want = rows - {r.doc_id for r in find_leaks(docs, bench).collect()}
        assert ids(left) == sorted(want)
        docs = spark.createDataFrame(left.collect(), left.schema)
    packed = {tuple(r) for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).drop("sequence_id", "offset").collect()}
    whole = corpus_pipeline.run(spark, SF)
    assert sum(r.length for r in whole.collect()) == sum(p[2] for p in packed)
    assert {r.doc_id for r in whole.collect()} == set(ids(docs))


def test_labelled_good_documents_are_kept(spark):
    docs, labels = read(spark, "sf0.01", "documents"), read(spark, "sf0.01", "labels")
    kept = set(ids(corpus_pipeline.quality(spark, docs, "/root/testdata/sf0.01")))
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(good - kept) <= 0.02 * len(good)


def test_odd_and_empty_documents_go_through_every_stage(spark):
    for rows in (ODD, []):
        docs = table(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        assert (docs.count() > 0) == bool(rows)
    assert pack(table(spark, []), corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")).count() == 0
