"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

DataFrame operations only. A test item's MinHash sketch is its least shingle hashes. Items are partitioned by size;
in the class of size n the sketch has n - ceil(t n) + m values and a document is a candidate if it holds m of them
(m grows with the class). A document that holds a share t of the shingles lacks at most n - ceil(t n) of them, so it
always has m sketch values: the search misses nothing, and the documents' length plays no part. Candidates are then
checked by their shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import BROADCAST_ROWS, free_name, materialize

#: Least size of an item's class and the sketch values asked for in it.
CLASSES = ((1, 1), (32, 2), (128, 4), (512, 8))
#: Characters of item shingles up to which the items are broadcast.
BROADCAST_CHARS = 64_000_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), "")


def shingle_hashes(w: Column, hashes: Column, n: int) -> Column:
    """Distinct hashes of all runs of ``n`` words; fewer words are one shingle, no words none."""
    runs = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(n)]))
    return F.array_distinct(F.when(F.size(w) >= n, runs).when(F.size(w) > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>")))


def shingles(w: Column, n: int) -> Column:
    runs = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.array_distinct(F.when(F.size(w) >= n, runs).when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>")))


def hashed(rows: DataFrame, n: int, *keep: str) -> DataFrame:
    rows = rows.select(*keep, words(F.col("text")).alias("w"))
    rows = rows.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))
    return rows.select(*keep, shingle_hashes(F.col("w"), F.col("wh"), n).alias("h"))


def sketches(items: DataFrame, threshold: float, n: int) -> DataFrame:
    """Rows (h, item_id, need): the sketch values of each item and how many of them a candidate has."""
    sized = materialize(hashed(items, n, "item_id"), "leak-item-hashes")  # a filter on it mustn't repeat the hashing
    size = F.size("h")
    m = F.lit(CLASSES[0][1])
    for least, hits in CLASSES[1:]:
        m = F.when(size >= least, F.lit(hits)).otherwise(m)
    lack = size - F.ceil(size * F.lit(threshold) - F.lit(1e-9))
    sized = sized.where(size > 0).withColumn("m", F.least(m, size - lack)).withColumn("k", (lack + F.col("m")).cast("int"))
    return sized.select("item_id", F.col("m").alias("need"), F.explode(F.slice(F.array_sort("h"), F.lit(1), F.col("k"))).alias("h"))


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.8, shingle_words: int = 5) -> DataFrame:
    """Pairs of a document and a test item of whose distinct shingles it holds a share of at least ``threshold``.

    Rows (doc_id long, item_id long, n_shingles int, n_found int, containment double), one a pair. Words are runs of
    letters, marks and digits, lower-cased. Fewer words than a shingle are one shingle, so that a shorter item is
    found only where it is the whole document; texts without words (null, empty) hold and are held by nothing. Of
    rows that share a doc_id (or an item_id) the best pair counts. Rows with a null id are left out of the search.
    Empty tables give no rows; other columns are ignored.
    """
    n = shingle_words
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    sketch = materialize(sketches(items, threshold, n), "leak-sketches")
    probe = F.broadcast(sketch) if sketch.count() <= BROADCAST_ROWS else sketch
    # explode_outer: explode would add a filter on h, for which the hashing would be repeated below
    hits = hashed(docs, n, "doc_id").select("doc_id", F.explode_outer("h").alias("h")).join(probe, "h").groupBy("doc_id", "item_id", "need").count()
    found = hits.where("count >= need").groupBy("doc_id").agg(F.collect_set("item_id").alias("items"))
    found = materialize(found, "leak-candidates").withColumnRenamed("doc_id", "found_id")
    few = found.agg(F.count("*"), F.coalesce(F.sum(F.size("items")), F.lit(0))).first()
    texts = docs.join(F.broadcast(found) if few[0] <= BROADCAST_ROWS // 4 and few[1] <= BROADCAST_ROWS else found, F.col("doc_id") == F.col("found_id"))
    texts = texts.withColumn("w", words(F.col("text"))).select("doc_id", "items", shingles(F.col("w"), n).alias("own"))
    wanted = materialize(items.withColumn("w", words(F.col("text"))).select(F.col("item_id"), shingles(F.col("w"), n).alias("item")), "leak-items").where(F.size("item") > 0)
    chars = wanted.agg(F.sum(F.aggregate("item", F.lit(0).cast("long"), lambda a, x: a + F.length(x)))).first()[0] or 0
    pairs = texts.select("doc_id", "own", F.explode("items").alias("item_id")).join(F.broadcast(wanted) if chars <= BROADCAST_CHARS else wanted, "item_id")
    pairs = pairs.select("doc_id", "item_id", F.size("item").alias("n_shingles"), F.size(F.array_intersect("item", "own")).alias("n_found"))
    pairs = pairs.withColumn("containment", F.col("n_found") / F.col("n_shingles")).where(F.col("containment") >= threshold)
    best = pairs.groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_found", "n_shingles")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_shingles", "b.n_found", "b.containment")


def drop_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.8, shingle_words: int = 5) -> DataFrame:
    """The rows of ``docs`` that hold no test item; columns stay. Rows with a null doc_id stay.

    The ids of the others are counted; few of them are broadcast, so that no text is shuffled.
    """
    gone_id = free_name(docs, "gone_id")
    gone = materialize(find_leaks(docs, items, threshold, shingle_words).select(F.col("doc_id").alias(gone_id)).distinct(), "leak-gone")
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, F.col("doc_id") == F.col(gone_id), "left_anti")
