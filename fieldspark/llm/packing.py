"""Best-fit packing of tokenised documents, planned over the histogram of lengths.

Best-fit decreasing needs only how many pieces have each length, at most ``max_tokens`` numbers. The plan moves whole
runs of equal sequences at a time: a slot run says that the pieces of one length with ranks [rank_lo, rank_hi) go,
``each`` to a sequence, to the sequences from ``seq_lo`` on at ``offset``. Pieces take their slots by joining on
their rank within their length; ranks are counted in salted groups, so that a common length is no single task.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldspark.llm.common import KEPT_BY_WORKER, arrow_map, materialize

#: Pre-tokens kept by a worker in each of two generations.
KEPT = 100_000
#: The tokenizer's split of lower-cased Latin-1 text; what it can't be sure of is left to the library.
LETTERS, DIGITS, WHITE = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
PRE_TOKEN = re.compile(f"[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{DIGITS}]|[^{WHITE}{LETTERS}{DIGITS}]+")
UNSURE = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Kept(dict):
    """Values of ``make`` by key, kept in two generations.

    Once the younger is full it becomes the older; what isn't asked for again until the next turn goes.
    """

    def __init__(self, make: Callable[[str], bytes], bound: int = KEPT):
        super().__init__()
        self.make, self.bound, self.old = make, bound, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) < 100:
            if len(self) >= self.bound:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class WordTokenizer:
    """Ids of a byte-level tokenizer over lower-cased words, as little-endian unsigned 32-bit bytes.

    A Latin-1 text is split into the tokenizer's own pre-tokens here, and each pre-token's ids are kept. Other texts
    go chunk by chunk between spaces; a chunk that isn't Latin-1 goes to the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kept = Kept(self.pre_token)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.symbol = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def pre_token(self, word: str) -> bytes:
        symbols = word if word.isascii() else "".join(map(self.symbol.__getitem__, word.encode()))
        return array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def latin(self, text: str) -> bytes:
        return b"".join(map(self.kept.__getitem__, PRE_TOKEN.findall(text.lower())))

    def encode(self, text: str) -> bytes:
        if is_latin(text):
            return self.latin(text)
        return b"".join([self.latin(x) if is_latin(x) else self.whole(x) for x in text.replace("\n", " ").split(" ")])


def is_latin(text: str) -> bool:
    """Whether all of the text is Latin-1 (so it is in normal form C) without control tokens and odd separators."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return not any(x in text for x in UNSURE)


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


KEPT_BY_WORKER[__name__] = word_tokenizer.cache_clear


def token_pieces(docs: DataFrame, path: str, max_tokens: int = 4096, end_id: int = 1) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): each document's ids and ``end_id``, cut at every ``max_tokens``."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokenizer, end = word_tokenizer(path), np.array([end_id], "<u4").tobytes()
        out: list[tuple] = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = tokenizer.encode(text or "") + end
            for piece, start in enumerate(range(0, len(ids), 4 * max_tokens)):
                part = ids[start : start + 4 * max_tokens]
                out.append((doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part)))
        columns = list(zip(*out, strict=True))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    view = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(view, one, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_plan(histogram: dict[int, int], max_tokens: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: slot runs (length, rank_lo, rank_hi, seq_lo, each, offset).

    ``room`` holds runs of sequences with equal room left, by that room. A length fills the tightest room it fits;
    a run of more sequences than needed is split. Each length makes at most a handful of new runs, so the plan's
    size depends on ``max_tokens`` alone, not on the number of documents.
    """
    plan: list[tuple[int, int, int, int, int, int]] = []
    rooms: list[int] = []
    room: dict[int, list[tuple[int, int]]] = {}
    n_sequences = 0

    def put(left: int, lo: int, hi: int) -> None:
        if left and lo < hi:
            if left not in room:
                insort(rooms, left)
                room[left] = []
            room[left].append((lo, hi))

    for length in sorted(histogram, reverse=True):
        rank, total = 0, histogram[length]

        def take(lo: int, hi: int, left: int, length: int = length, total: int = total) -> int:
            """Place what remains into the sequences [lo, hi) that have ``left`` tokens of room."""
            nonlocal rank
            fits = left // length
            full = min(hi - lo, (total - rank) // fits)
            if full:
                plan.append((length, rank, rank + full * fits, lo, fits, max_tokens - left))
                rank += full * fits
                put(left - fits * length, lo, lo + full)
            lo += full
            if lo < hi and rank < total:
                rest = total - rank
                plan.append((length, rank, total, lo, rest, max_tokens - left))
                rank = total
                put(left - rest * length, lo, lo + 1)
                lo += 1
            put(left, lo, hi)
            return hi

        while rank < total and rooms and (at := bisect_left(rooms, length)) < len(rooms):
            left = rooms[at]
            runs = room[left]
            lo, hi = runs.pop()
            if not runs:
                del room[left], rooms[at]
            take(lo, hi, left)
        if rank < total:
            fits = max_tokens // length
            made = -(-(total - rank) // fits)
            lo, n_sequences = n_sequences, n_sequences + made
            take(lo, n_sequences, max_tokens)
    return plan


def plan_table(spark: SparkSession, plan: list[tuple]) -> DataFrame:
    return spark.createDataFrame(plan or [(0, 0, 0, 0, 1, 0)], "p_length long, rank_lo long, rank_hi long, seq_lo long, each long, base long")


def assign(pieces: DataFrame, max_tokens: int, salts: int | None = None) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Lengths are 1 to ``max_tokens``. Null ids and repeated rows are placed each on its own; an empty table stays empty.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_table(spark, best_fit_plan(histogram, max_tokens))
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("place", F.row_number().over(within)).join(sizes, ["length", "salt"]).withColumn("rank", F.col("ahead") + F.col("place") - 1)
    slot = (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("rank_lo")) & (F.col("rank") < F.col("rank_hi"))
    nth = F.col("rank") - F.col("rank_lo")
    return ranked.join(F.broadcast(plan), slot).select(
        *pieces.columns,
        (F.col("seq_lo") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("base") + F.pmod(nth, F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, path: str | None = None, max_tokens: int = 4096, end_id: int = 1) -> DataFrame:
    """Pack documents into sequences of at most ``max_tokens`` tokens; one row a piece.

    Rows (doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long). A document
    is its ids by the tokenizer at ``path`` (without special tokens) and ``end_id``; null and empty texts are
    ``end_id`` alone. Only documents longer than ``max_tokens`` are cut. Sequences are gapless from offset 0.
    Rows that share a doc_id (null ones too) are packed each on its own; other columns are ignored; an empty table
    gives an empty table.
    """
    pieces = materialize(token_pieces(docs, path or vocabulary("word_bpe_49k.json"), max_tokens, end_id), "pack-pieces")
    return assign(pieces, max_tokens)
