"""What Python workers hold: texts by few rows, and no caches of an earlier stage."""

from contextlib import contextmanager

import corpus_pipeline
from fieldspark.llm import common, packing

SF = "/root/testdata/sf0.001"


def test_texts_go_to_python_by_few_rows(spark, monkeypatch):
    """language_id was stopped above an executor's memory with batches of 10,000 texts (pipeline, round 3)."""
    asked = []

    @contextmanager
    def noted(session, rows):
        with common.batches_of(session, rows):
            asked.append(int(session.conf.get(common.BATCH_ROWS)))
            yield

    monkeypatch.setattr(corpus_pipeline, "batches_of", noted, raising=False)
    before = spark.conf.get(common.BATCH_ROWS)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.language_id(spark, docs, SF)
    assert asked == [corpus_pipeline.TEXT_ROWS] and spark.conf.get(common.BATCH_ROWS) == before
    assert "MapInArrow" not in kept._jdf.queryExecution().toString()  # it has run, by those batches
    assert 0 < kept.count() <= docs.count() and kept.columns == docs.columns


def test_a_worker_keeps_no_caches_of_other_stages():
    path = packing.vocabulary("word_bpe_49k.json")
    mine = packing.word_tokenizer(path)
    common.only_caches_of("fieldspark.llm.packing")
    assert packing.word_tokenizer(path) is mine
    common.only_caches_of("fieldspark.llm.langid")
    assert packing.word_tokenizer.cache_info().currsize == 0
