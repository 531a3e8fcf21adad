"""The pipeline's stages, each against a brute-force version on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from encore.llm import quality
from encore.llm.tables import read

from .test_operators import brute_groups, brute_leaks, chains_and_shared_ids
from .test_windows import brute_words

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    import sentencepiece
    docs = read(spark, SF, "documents")
    columns, labels = docs.columns, read(spark, SF, "labels")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, tables[-1], SF)
        tables.append(spark.createDataFrame(out.collect(), out.schema).cache())
    assert all(t.columns == columns for t in tables[:-1])
    rows = [{r.doc_id: r for r in t.collect()} for t in tables]
    good = {r.doc_id for r in quality.scored(docs, labels).filter("predicted = 1").collect()}
    assert set(rows[1]) == good and 0 < len(good) < len(rows[0])
    groups = brute_groups([(i, r.text) for i, r in rows[1].items()], corpus_pipeline.PERCENT)
    assert set(rows[2]) == {i for i, g in groups.items() if g[2]}
    words = brute_words([(i, r.text) for i, r in rows[2].items()])
    for (i, _), (n, gone, _) in words.items():
        assert len((rows[3][i].text or "").encode().split()) == n - gone
        assert rows[3][i].n_chars == len(rows[3][i].text or "")
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    bad = {i for i, _ in brute_leaks([(i, r.text) for i, r in rows[3].items()], items)}
    assert set(rows[4]) == set(rows[3]) - bad and bad
    sp = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.sentencepiece_model())
    assert set(rows[5]) == set(rows[4])
    assert all(r.ids == sp.encode(r.text or "", add_eos=True) and r.n_tokens == len(r.ids) for r in rows[5].values())
    run = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in run.collect()} == set(rows[5])


def test_empty_documents(spark):
    docs = read(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_extra_columns_stay(spark, documents):
    extra = {"row": F.lit("r"), "_id": F.lit(1), "spans": F.lit(2), "ids": F.lit("i"), "score": F.lit(0.1)}
    docs = documents.withColumns(extra)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[:len(docs.columns)] == docs.columns
        got = out.collect()
        assert got and all(r["row"] == "r" and r["spans"] == 2 for r in got)
        docs = spark.createDataFrame(got, out.schema)


def test_decontamination_stage_with_null_and_repeated_ids(spark):
    item = max((r.text or "" for r in read(spark, SF, "benchmark").collect()), key=len)
    rows = [(None, item), (None, "clean one"), (None, "clean two"), (None, None), (4, "a " + item), (4, "clean"), (5, "b")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, _gone_id int").repartition(2)
    out = dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, SF)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([r for r in rows if item not in (r[1] or "")], key=repr)


def test_near_duplicate_stage_with_null_and_repeated_ids(spark):
    rows = chains_and_shared_ids()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, th int").repartition(3)
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF)
    assert out.columns == docs.columns
    got = out.collect()
    texts = {t: k for k, t in enumerate(sorted({t for _, t in rows if t}))}
    groups = brute_groups([(k, t) for t, k in texts.items()], corpus_pipeline.PERCENT)
    assert sorted(groups[texts[r.text]][1] for r in got if r.text) == sorted({g[1] for g in groups.values()})
    assert sum(r.text is None for r in got) == 2
    assert any(r.doc_id == 5 and r.text.startswith("b0 ") for r in got if r.text)


def test_encoding_stays_beside_input_columns_of_its_names(spark):
    import sentencepiece
    docs = spark.createDataFrame([(1, "some text", "i", 5), (2, None, "j", 6)],
                                 "doc_id long, text string, ids string, encoded_ids int")
    out = corpus_pipeline.encoded(spark, docs, SF)
    assert out.columns == [*docs.columns, "n_tokens", "encoded_encoded_ids", "decoded"]
    sp = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.sentencepiece_model())
    got = {r.doc_id: r for r in out.collect()}
    assert [(got[i].ids, got[i].encoded_ids) for i in (1, 2)] == [("i", 5), ("j", 6)]
    assert all(r.encoded_encoded_ids == sp.encode(r.text or "", add_eos=True) for r in got.values())
