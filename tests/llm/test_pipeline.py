"""The corpus pipeline against its operators and brute force, stage by stage."""

import random
from collections import Counter

import numpy as np

import corpus_pipeline
from aisle.llm import mixing, pieces
from tests.llm.conftest import DOCS, edge_texts, prose, rows_of
from tests.llm.test_neardup import brute as components
from tests.llm.test_rules import brute as counts

BY_NAME = dict(corpus_pipeline.STAGES)


def corpus(spark):
    rng = random.Random(21)
    texts = edge_texts() + [prose(rng, 150) for _ in range(60)]
    texts += [t + " more" for t in texts[-20:]] + texts[-5:]
    docs = spark.createDataFrame(rows_of(texts), DOCS).repartition(4)
    labels = spark.createDataFrame([(3 * i, 0 if i in (14, 16, 70) else 1, 0) for i in range(0, len(texts), 2)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


def stage(spark, name, docs, folder):
    out = f"{folder}/{name}-{random.randrange(10 ** 9)}"
    BY_NAME[name](spark, docs, folder).write.parquet(out)
    return spark.read.parquet(out)


def test_stages_take_effect_and_keep_columns(spark, table):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_dedup", "source_mix", "encode_pieces"]
    docs, labels = corpus(spark)
    folder = table(documents=docs, labels=labels)
    now = spark.read.parquet(f"{folder}/documents.parquet")

    ruled = stage(spark, "quality_rules", now, folder)
    kept = {r.doc_id for r in ruled.collect()}
    for r in now.collect():
        c = counts(r.text)
        if c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]:
            assert r.doc_id not in kept
    assert len(kept) > 60

    chosen = stage(spark, "quality_classifier", ruled, folder)
    assert {r.doc_id for r in chosen.collect()} < kept or chosen.count() == ruled.count()

    single = stage(spark, "near_dedup", chosen, folder)
    comp, _ = components([(r.doc_id, r.text) for r in chosen.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(comp.values()))
    assert single.count() < chosen.count()

    mixed = stage(spark, "source_mix", single, folder)
    want = {r.doc_id: r.copies for r in mixing.taken(single).collect() if r.copies}
    assert Counter(r.doc_id for r in mixed.collect()) == want
    for df in (ruled, chosen, single, mixed):
        assert df.columns == now.columns

    coded = stage(spark, "encode_pieces", mixed, folder)
    coder = pieces.PieceCoder(pieces.vocabulary_path())
    texts = {r.doc_id: r.text for r in now.collect()}
    assert coded.count() == mixed.count()
    ordered = [r.doc_id for r in mixing.mix(single).collect()]
    assert [r.doc_id for r in coded.orderBy("training_rank").collect()] == ordered
    for r in coded.collect():
        assert coder.decode(np.array(r.ids, "<i4")) == texts[r.doc_id]


def test_run_equals_its_stages(spark, table):
    docs, labels = corpus(spark)
    folder = table(documents=docs, labels=labels)
    out = corpus_pipeline.run(spark, folder)
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for name, _ in corpus_pipeline.STAGES:
        now = stage(spark, name, now, folder)
    key = lambda r: (r.doc_id, tuple(r.ids))
    assert sorted(map(key, out.collect())) == sorted(map(key, now.collect())) and out.count()


def test_every_stage_takes_an_empty_table(spark, empty_docs, table):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    folder = table(documents=empty_docs, labels=labels)
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, empty_docs, folder).count() == 0, name


def test_registered_beside_the_ten_operators():
    import __spark_entry__ as E
    names = E.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
