"""Line deduplication: a once-seen and a twice-seen Bloom filter pick suspected repeats; only those shuffle.

1. Every task adds its documents' line hashes to two filters: a hash that the once filter already has goes to the
   twice filter. Filters travel as compressed blocks and merge by block: once = or of the onces, twice = or of the
   twices and of what two onces share. A line found in two documents is therefore always in the merged twice filter.
2. Lines that the twice filter has are suspects. Only these shuffle, as whole keys, and are counted exactly.
3. Few confirmed keys (counted first) are broadcast, and one pass drops their lines where the documents are. Beyond
   that documents without suspects never leave their task; the others meet their confirmed keys by document id.

The filter has ``bits_per_line`` bits a line up to ``max_filter_bytes``. Beyond that bound more lines are suspects
(in the end all of them shuffle); the result stays exact.
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
from pyspark.sql.types import LongType, StructType

from fieldspark.llm.common import free_name, materialize

SPACE = b" \t\n\x0b\x0c\r"
BLOCK = 1 << 15
#: Confirmed keys, and bytes of them, up to which they are broadcast.
CONFIRMED, CONFIRMED_BYTES = 100_000, 8_000_000
#: Of more confirmed keys: documents and bytes of a key that is broadcast, and how many may be.
HUB_ROWS, HUB_BYTES, MANY_HUBS = 10_000, 1_024, 20_000


def line_keys(text: bytes) -> list[bytes]:
    """One key a line: white space stripped at both ends and A-Z lower-cased."""
    return [x.strip(SPACE) for x in text.lower().split(b"\n")]


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def has(bloom: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the filter has both positions of each column of ``at``."""
    return ((bloom[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def put(bloom: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bloom, (at >> np.uint64(3)).ravel(), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8).ravel())


def positions(keys: list[bytes], bits: int) -> np.ndarray:
    """Two filter positions a key, from one 64-bit hash."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))
    return np.stack([h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1)])


def build_filters(docs: DataFrame, bits: int, min_chars: int) -> DataFrame:
    """Rows (block, once, twice) of each task's filters; empty blocks are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        pending: list[bytes] = []

        def add() -> None:
            if not pending:
                return
            keys, counts = np.unique(np.fromiter((xxhash.xxh3_64_intdigest(k) for k in pending), np.uint64, len(pending)), return_counts=True)
            at = np.stack([keys & np.uint64(bits - 1), (keys >> np.uint64(32)) & np.uint64(bits - 1)])
            put(twice, at[:, has(once, at) | (counts > 1)])
            put(once, at)
            pending.clear()

        for batch in batches:
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                if text:
                    pending.extend({k for k in line_keys(text) if long_enough(k, min_chars)})
            if len(pending) > 200_000:
                add()
        add()
        rows = {"block": [], "once": [], "twice": []}
        for i in range(0, len(once), BLOCK):
            if once[i : i + BLOCK].any():
                rows["block"].append(i // BLOCK)
                rows["once"].append(zlib.compress(once[i : i + BLOCK].tobytes(), 1))
                rows["twice"].append(zlib.compress(twice[i : i + BLOCK].tobytes(), 1))
        yield pa.RecordBatch.from_arrays([pa.array(rows["block"], pa.int32()), pa.array(rows["once"], pa.binary()), pa.array(rows["twice"], pa.binary())], names=list(rows))

    return docs.select("text").mapInArrow(run, "block int, once binary, twice binary")


def merge_filters(blocks: DataFrame) -> DataFrame:
    """Rows (block, twice) of the merged twice filter; each task holds two blocks for each block number it sees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for block, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (once, twice))
                if block in held:
                    was = held[block]
                    held[block] = [was[0] | o, was[1] | t | was[0] & o]
                else:
                    held[block] = [o, t]
        found = {b: x[1] for b, x in held.items() if x[1].any()}
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in found.values()], pa.binary())], names=["block", "twice"])

    return blocks.repartition("block").mapInArrow(run, "block int, twice binary")


def repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, bits_per_line: int = 16, max_filter_bytes: int = 1 << 25):
    """(suspected repeats as rows (key, doc_id), confirmed keys as rows (key, keep_id), the broadcast twice filter)."""
    spark = docs.sparkSession
    view = docs.select("doc_id", "text")
    lines = view.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    bits = BLOCK * 8
    while bits < min(lines * bits_per_line, max_filter_bytes * 8):
        bits *= 2
    merged = np.zeros(bits // 8, np.uint8)
    for row in merge_filters(build_filters(view, bits, min_chars)).collect():
        merged[row.block * BLOCK : (row.block + 1) * BLOCK] = np.frombuffer(zlib.decompress(row.twice), np.uint8)
    shared, token = spark.sparkContext.broadcast(zlib.compress(merged.tobytes(), 1)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suspects = Suspects(shared, token, bits, min_chars)
        for batch in batches:
            keys, ids = [], []
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), suspects.of(batch.column("text")), strict=True):
                keys += found
                ids += [doc_id] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()).cast(pa.string()), pa.array(ids, pa.int64())], names=["key", "doc_id"])

    suspected = materialize(view.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, "key string, doc_id long"), "line-suspects")
    confirmed = (
        suspected.distinct().groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keep_id")).where(F.col("n_docs") >= min_docs).select("key", "keep_id", "n_docs")
    )
    return suspected, materialize(confirmed, "line-confirmed"), (shared, token, bits)


class Suspects:
    """Looks the lines of documents up in the twice filter, which is unpacked once a worker and call (``token``)."""

    unpacked: dict[str, np.ndarray] = {}

    def __init__(self, shared, token: str, bits: int, min_chars: int):
        if token not in Suspects.unpacked:
            Suspects.unpacked = {token: np.frombuffer(zlib.decompress(shared.value), np.uint8)}
        self.filter, self.bits, self.min_chars = Suspects.unpacked[token], bits, min_chars

    def of(self, texts: pa.Array) -> list[list[bytes]]:
        """The distinct suspected keys of each text."""
        keys: list[bytes] = []
        ends = []
        for text in texts.cast(pa.binary()).to_pylist():
            if text:
                keys.extend({k for k in line_keys(text) if long_enough(k, self.min_chars)})
            ends.append(len(keys))
        if not keys:
            return [[] for _ in ends]
        at = positions(keys, self.bits)
        hit = np.flatnonzero(has(self.filter, at))
        out: list[list[bytes]] = []
        start = 0
        for end in np.searchsorted(hit, ends):
            out.append([keys[i] for i in hit[start:end]])
            start = end
        return out


def with_confirmed(suspected: DataFrame, confirmed: DataFrame) -> DataFrame:
    """The rows of ``suspected`` whose key is confirmed, with its keep_id.

    Keys of more than ``HUB_ROWS`` documents and at most ``HUB_BYTES`` are broadcast (few, as the rows bound them), so that
    a line of a million documents is no task of its own; the others meet by a shuffle.
    """
    hub = (F.col("n_docs") > HUB_ROWS) & (F.octet_length("key") <= HUB_BYTES)
    hubs = confirmed.where(hub).select("key", "keep_id")
    if not 0 < hubs.count() <= MANY_HUBS:
        return suspected.join(confirmed.select("key", "keep_id"), "key")
    others = suspected.join(F.broadcast(hubs.select("key")), "key", "left_anti").join(confirmed.where(~hub).select("key", "keep_id"), "key")
    return suspected.join(F.broadcast(hubs), "key").unionByName(others)


def drop_in_place(docs: DataFrame, keep: dict[bytes, int | None]) -> DataFrame:
    """``docs`` without the lines whose key ``keep`` has with another doc_id; adds line_count and line_dropped."""
    shared = docs.sparkSession.sparkContext.broadcast(keep)
    at, names = docs.columns.index("text"), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = shared.value
        for batch in batches:
            texts, counts, dropped = [], [], []
            ids = batch.column(names.index("doc_id")).cast(pa.int64()).to_pylist()
            for doc_id, text in zip(ids, batch.column(at).cast(pa.binary()).to_pylist(), strict=True):
                lines, keys = (text or b"").split(b"\n"), line_keys(text or b"")
                gone = {k for k in keys if k in keep and keep[k] != doc_id}
                counts.append(len(lines))
                kept = [x for x, k in zip(lines, keys, strict=True) if k not in gone] if gone else lines
                dropped.append(len(lines) - len(kept))
                texts.append(b"\n".join(kept) if gone else text)
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())], names=[*names, "line_count", "line_dropped"])

    return docs.mapInArrow(run, StructType(list(docs.schema.fields)).add("line_count", LongType()).add("line_dropped", LongType()))


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, bits_per_line: int = 16, max_filter_bytes: int = 1 << 25) -> DataFrame:
    """Drop lines that many documents share.

    A line's key has the white space at both ends stripped and A-Z lower-cased. Keys of at least ``min_chars`` code
    points that at least ``min_docs`` documents hold lose all their lines, also repeats inside one document, except
    in the largest doc_id that holds them. Returns the columns of ``docs`` with ``text`` replaced, then
    ``line_count`` (before dropping) and ``line_dropped``, both long; columns of these names are replaced.

    Null texts stay null and empty ones empty: one empty line each, never dropped. Rows that share a doc_id count as
    one document and keep or lose a line together. Null doc_ids count as one document, which is never the largest unless
    it is the only holder. An empty table gives an empty table; other columns pass through unchanged.
    """
    suspected, confirmed, (shared, token, bits) = repeated_lines(docs, min_chars, min_docs, bits_per_line, max_filter_bytes)
    extra = [c for c in docs.columns if c not in ("line_count", "line_dropped")]
    few = confirmed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("key")), F.lit(0))).first()
    if few[0] <= CONFIRMED and few[1] <= CONFIRMED_BYTES:
        return drop_in_place(docs.select(*extra), {r.key.encode(): r.keep_id for r in confirmed.collect()})
    drop_id, drop_keys = free_name(docs, "drop_id"), free_name(docs, "drop_keys")
    drop = with_confirmed(suspected, confirmed).where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    drop = drop.groupBy("doc_id").agg(F.collect_set("key").alias(drop_keys)).withColumnRenamed("doc_id", drop_id)
    base = docs.select(*extra)
    schema = base.schema
    arrow_text = extra.index("text")

    def part(want: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            suspects = Suspects(shared, token, bits, min_chars)
            for batch in batches:
                mask = pa.array([bool(x) == want for x in suspects.of(batch.column(arrow_text))], pa.bool_())
                yield batch.filter(mask)

        return base.mapInArrow(run, schema)

    hit = part(True).join(drop, F.col("doc_id").eqNullSafe(F.col(drop_id)), "left").drop(drop_id)
    fields = list(base.schema.fields)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, dropped = [], [], []
            for text, gone in zip(batch.column(arrow_text).cast(pa.binary()).to_pylist(), batch.column(drop_keys).to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                counts.append(len(lines))
                if gone:
                    out = {x.encode() for x in gone}
                    kept = [x for x, k in zip(lines, line_keys(text), strict=True) if k not in out]
                    texts.append(b"\n".join(kept))
                    dropped.append(len(lines) - len(kept))
                else:
                    texts.append(text)
                    dropped.append(0)
            columns = [batch.column(i) for i in range(len(fields))]
            columns[arrow_text] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())], names=[*(f.name for f in fields), "line_count", "line_dropped"])

    out_schema = StructType(list(fields)).add("line_count", LongType()).add("line_dropped", LongType())
    touched = hit.mapInArrow(finish, out_schema)
    count = F.length(F.coalesce("text", F.lit(""))) - F.length(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(""))) + 1
    clean = part(False).withColumns({"line_count": count.cast("long"), "line_dropped": F.lit(0).cast("long")})
    return clean.unionByName(touched)
