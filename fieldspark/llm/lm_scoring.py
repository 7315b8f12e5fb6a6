"""Stupid-backoff scores: n-gram count tables partitioned by hash, joined to the documents' n-grams, summed a document.

1. Documents become blocks of about ``block_tokens`` words, coded by a dictionary of word hashes, in a shared table.
2. Each block sends the distinct hashes of its n-grams of every order, with their counts there, to the hash range
   (bucket) that they fall in. A bucket is one part of the count table: it adds its blocks' counts up.
3. Buckets answer each block with the corpus counts in the order asked. The block joins them to its n-grams and sums
   the scores of each document.

A frequent n-gram is one entry a block, so no bucket grows with how often it occurs. What is gathered is as large as
the corpus has distinct n-grams in its blocks; nothing but the numbers of words and blocks reaches the driver. The
exploded n-grams travel as sorted, compressed arrays: as plain rows of a hash, a block and a count they took six times
the input's size on disk.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import materialize

WORDS = 400_000
BLOCK = "block_id long, n_words long, doc_ids array<long>, lens binary, words binary, codes binary"


def squeeze(values: np.ndarray) -> bytes:
    """Integers with their bytes of like weight together, compressed."""
    if not len(values):
        return b""
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), 1)


def unsqueeze(data: bytes, kind: str) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, -1).T).view(kind).ravel()


def make_blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    """Rows of BLOCK: words are runs between ASCII white space with A-Z lower-cased."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        ids, lens, hashes, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal ids, lens, hashes, size
            codes, words, n = np.unique(np.concatenate(hashes or [np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")  # frequent words get small numbers, which compress better
            number = np.empty(len(order), np.uint32)
            number[order] = np.arange(len(order), dtype=np.uint32)
            codes, words = codes[order], number[words]
            row = [[uuid.uuid4().int >> 65], [size], [ids], [squeeze(np.array(lens, np.int64))], [squeeze(words)], [squeeze(codes)]]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
            ids, lens, hashes, size = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], names=["block_id", "n_words", "doc_ids", "lens", "words", "codes"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                words = (text or b"").lower().split()
                try:
                    own = list(map(known.__getitem__, words))
                except KeyError:
                    if len(known) > WORDS:
                        known.clear()
                    known.update((w, xxhash.xxh3_64_intdigest(w)) for w in set(words) if w not in known)
                    own = list(map(known.__getitem__, words))
                ids.append(doc_id)
                lens.append(len(own))
                if own:
                    hashes.append(np.array(own, np.uint64))
                size += len(own)
                if size >= block_tokens:
                    yield block()
        if ids:
            yield block()

    view = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return view.mapInArrow(run, BLOCK)


def hash_bits(total: int) -> int:
    """Width of n-gram hashes: a given n-gram meets another one's hash with a chance of about 1 in 16 million at any size."""
    return min(64, 24 + max(1, total).bit_length())


def ngrams(lens: np.ndarray, hashes: np.ndarray, order: int, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order from 1 on: (hashes of the n-grams, the place of each one's last word); none crosses documents."""
    cut = np.uint64(64 - bits)
    n = len(hashes)
    place = np.arange(n) - np.repeat(np.cumsum(lens) - lens, lens)
    out = [(hashes >> cut, np.arange(n))]
    h = hashes
    for k in range(2, order + 1):
        h = (h[: n - k + 1] * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[k - 1 :]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        at = np.flatnonzero(place[k - 1 :] >= k - 1)
        out.append((h[at] >> cut, at + k - 1))
    return out


def open_block(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(lens, word hashes) of a block."""
    return unsqueeze(row["lens"], "i8"), unsqueeze(row["codes"], "u8")[unsqueeze(row["words"], "u4")]


def partial_counts(blocks: DataFrame, order: int, buckets: int, bits: int) -> DataFrame:
    """Rows (bucket, block_id, ord, hashes, counts): each block's distinct n-grams by hash range, in order of hash."""
    edges = np.array([(i << bits) // buckets for i in range(1, buckets)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for k, (h, _) in enumerate(ngrams(*open_block(row), order, bits), 1):
                    keys, counts = np.unique(h, return_counts=True)
                    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                    out = [(b, row["block_id"], k, squeeze(np.diff(keys[i:j], prepend=np.uint64(0))), squeeze(counts[i:j])) for b, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False)) if i < j]
                    columns = list(zip(*out, strict=True)) or [()] * 5
                    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["bucket", "block_id", "ord", "hashes", "counts"])

    return blocks.mapInArrow(run, "bucket int, block_id long, ord int, hashes binary, counts binary")


def answers(partial: DataFrame, parts: int) -> DataFrame:
    """Rows (bucket, block_id, ord, counts): the corpus counts of what each block asked for, in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def total() -> pa.RecordBatch:
            asked = [np.cumsum(unsqueeze(h, "u8"), dtype=np.uint64) for _, h, _ in held]
            keys, place = np.unique(np.concatenate(asked), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, place, np.concatenate([unsqueeze(c, "i8") for _, _, c in held]))
            ends = np.cumsum([len(a) for a in asked])[:-1]
            counts = [squeeze(sums[p]) for p in np.split(place, ends)]
            n = len(held)
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * n, pa.int32()), pa.array([b for b, _, _ in held], pa.int64()), pa.array([key[1]] * n, pa.int32()), pa.array(counts, pa.binary())], names=["bucket", "block_id", "ord", "counts"])

        for batch in batches:
            for bucket, block_id, k, h, c in zip(*(batch.column(n).to_pylist() for n in ("bucket", "block_id", "ord", "hashes", "counts")), strict=True):
                if key != (bucket, k):
                    if held:
                        yield total()
                    key, held = (bucket, k), []
                held.append((block_id, h, c))
        if held:
            yield total()

    dealt = partial.repartition(parts, "bucket", "ord").sortWithinPartitions("bucket", "ord")
    return dealt.mapInArrow(run, "bucket int, block_id long, ord int, counts binary")


def score_block(lens: np.ndarray, hashes: np.ndarray, counts: list[np.ndarray], total: int, order: int, backoff: float, min_count: int, bits: int) -> np.ndarray:
    """Sum of log scores of each document; ``counts[k-1]`` are of the block's distinct n-grams in order of hash."""
    n = len(hashes)
    if not n:
        return np.zeros(len(lens))
    of = []  # counts of the n-gram that ends at each word, 0 where there is none
    for (h, at), c in zip(ngrams(lens, hashes, order, bits), counts, strict=True):
        full = np.zeros(n, np.int64)
        full[at] = c[np.unique(h, return_inverse=True)[1]] if len(at) else 0
        of.append(full)
    best = np.log(of[0] / total)
    for k in range(1, order):
        has = np.concatenate([np.zeros(1, np.int64), of[k - 1][:-1]])  # the context ends a word earlier
        seen = of[k] >= min_count
        possible = of[k] > 0
        value = np.log(np.where(seen, of[k], 1) / np.where(seen, has, 1))
        best = np.where(seen, value, np.where(possible, best + np.log(backoff), best))
    owner = np.repeat(np.arange(len(lens)), lens)
    return np.bincount(owner, weights=best, minlength=len(lens))


def lm_scores(docs: DataFrame, order: int = 3, backoff: float = 0.4, min_count: int = 2, block_tokens: int = 2_000_000, buckets: int | None = None) -> DataFrame:
    """Rows (doc_id long, n_words long, log_score double, mean_log_score double), one a document.

    A word's score is c(n-gram) / c(context) for the longest n-gram that the corpus (all of ``docs``) holds at least
    ``min_count`` times, times ``backoff`` for each shorter order; at last c(word) / all words. At a document's start
    the orders that don't fit don't count as backing off. Counts are by hashes of
    ``hash_bits`` of the number of words. Null, empty and blank texts
    have no words, score 0 and a null mean. Rows that share a doc_id are scored each on its own and all count; other
    columns are ignored; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    blocks = materialize(make_blocks(docs, block_tokens), "lm-blocks")
    total, n_blocks = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.count("*")).first()
    bits = hash_bits(total)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or max(least, total // 2_000_000, 1)
    got = answers(partial_counts(blocks, order, buckets, bits), buckets)
    both = blocks.withColumn("kind", F.lit(0)).unionByName(got.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    columns = ["block_id", "kind", "ord", "bucket", "doc_ids", "lens", "words", "codes", "counts"]
    dealt = both.select(*columns).repartition(max(least, n_blocks // 2), "block_id").sortWithinPartitions("block_id", "kind", "ord", "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, held = None, {}

        def close() -> pa.RecordBatch:
            lens, hashes = open_block(row)
            counts = [np.concatenate([unsqueeze(c, "i8") for c in held.get(k, [])] or [np.zeros(0, np.int64)]) for k in range(1, order + 1)]
            sums = score_block(lens, hashes, counts, total, order, backoff, min_count, bits)
            mean = pa.array(np.divide(sums, lens, out=np.zeros(len(lens)), where=lens > 0), mask=lens == 0)
            return pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(lens, pa.int64()), pa.array(sums), mean], names=["doc_id", "n_words", "log_score", "mean_log_score"])

        for batch in batches:
            for i in range(batch.num_rows):
                x = {n: batch.column(j)[i].as_py() for j, n in enumerate(columns)}
                if x["kind"] == 0:
                    if row is not None:
                        yield close()
                    row, held = x, {}
                else:
                    held.setdefault(x["ord"], []).append(x["counts"])
        if row is not None:
            yield close()

    return dealt.mapInArrow(run, "doc_id long, n_words long, log_score double, mean_log_score double")
