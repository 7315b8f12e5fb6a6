"""Corpus pipeline: language ID, line dedup, near-dedup by exact Jaccard, benchmark decontamination, best-fit packing.

Each stage is (name, function of (spark, docs, sf_dir)); all but the last return the columns of ``documents``.
``run`` writes each stage's rows as Parquet in the shared folder and reads them back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm.common import batches_of, free_name, materialize
from fieldspark.llm.decontam import drop_leaks
from fieldspark.llm.langid import keep_identified
from fieldspark.llm.lines import line_dedup
from fieldspark.llm.neardup import keep_first_near
from fieldspark.llm.packing import pack, vocabulary

#: Rows of an Arrow batch of whole texts: the JVM's buffers and Python's share the executor's memory.
TEXT_ROWS = 1_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (null and empty texts too), or without a language over 40 % of their letters, go.

    Repeated rows are judged each on its own; columns of any name stay; an empty table stays empty.
    """
    with batches_of(spark, TEXT_ROWS):  # holds for plans that run here, so the rows are written here
        return materialize(keep_identified(docs, min_score=0.4), "pipeline-identified")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents share stay in the one of the largest doc_id; n_chars follows the text.

    Null and empty texts stay; rows that share a doc_id lose a line together; a null doc_id counts as one document;
    columns of any name stay as they are; an empty table stays empty.
    """
    counts = {c: free_name(docs, f"own_{c}") for c in docs.columns if c.lower() in ("line_count", "line_dropped")}
    out = line_dedup(docs.withColumnsRenamed(counts), min_chars=20, min_docs=3).drop("line_count", "line_dropped")
    out = out.withColumnsRenamed({new: old for old, new in counts.items()})
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out.select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (Jaccard similarity of 5-word shingles of 0.8 or more) the document with the least id stays.

    The trie self-join of SimHash fingerprints gives the candidates inside the buckets of shared shingles, at a distance
    that fits this similarity (four bits, as in op3_simhash, lose most of these pairs); links are verified exactly. Null
    and blank texts are copies of one another; rows with a null doc_id and columns of any name stay; of rows that share a
    doc_id all stay if it leads; an empty table stays empty.
    """
    return keep_first_near(docs, threshold=0.8, shingle_words=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 of a benchmark item's shingles go; null and empty texts hold nothing.

    Rows with a null doc_id stay; rows that share a doc_id go together; columns of any name stay.
    """
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), threshold=0.8, shingle_words=5)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece of a document in a sequence of at most 4096 tokens; null and empty texts are one end token.

    Rows that share a doc_id are packed each on its own; other columns are left out; an empty table gives no rows.
    """
    with batches_of(spark, TEXT_ROWS):
        return pack(docs, vocabulary("word_bpe_49k.json"), max_tokens=4096, end_id=1)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Viterbi, SimHash and tokenisation have no SQL; test_pipeline_stages in tests/llm/test_brute.py and
#: tests/llm/test_neardup.py hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
