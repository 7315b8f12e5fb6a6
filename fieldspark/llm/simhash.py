"""SimHash near-duplicates: fingerprints of word shingles, linked by a binary trie self-join.

Distinct fingerprints are dealt to wide buckets so that every pair within the error budget meets in one: of
``n_blocks`` bit blocks, ``n_blocks - budget`` are equal in such a pair, so each choice of that many blocks is one
table and its bits are the bucket's key. A bucket holds dozens of fingerprints. Inside it a fingerprint is a path in a
binary trie: node pairs are traversed together from the root down to single fingerprints, their differing bits add
up, and a pair is pruned once it exceeds the budget or once both nodes belong to one component already. A bucket gives
a spanning star for each component, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import arrow_map, connected_components, free_name, materialize
from fieldspark.llm.naming import with_names

PIECE = 200_000
#: Rows of buckets that a task holds at once, and node pairs that it expands at once.
CHUNK, FRONTIER = 100_000, 1_000_000
#: A bucket above this is cut into cells of two of its parts each.
BUCKET = 20_000


def fingerprint(text: bytes | None, shingle_words: int = 4) -> int:
    """64-bit SimHash: a bit is set if it is set in over half the shingles' XXH64 (seed 42); without words zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(joined)][min(shingle_words, len(words)) - 1 :]
    total, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, n, PIECE):
        j = min(n, i + PIECE)
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[i:j], ends[i:j], strict=True)], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 4) -> DataFrame:
    """Rows (doc_id, fp): fp is the fingerprint as a signed long. Null and empty texts have fingerprint zero.

    Rows with null or repeated ids keep their own; very long texts are hashed in pieces; other columns are ignored.
    """

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.fromiter((fingerprint(x, shingle_words) for x in batch.column("text").cast(pa.binary()).to_pylist()), np.uint64, batch.num_rows)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), one, "doc_id long, fp long")


class Labels:
    """Union-find over the rows of a chunk: label[i] is the least row of i's component."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.label[i], self.label[j]
            apart = a != b
            if not apart.any():
                return
            i, j = i[apart], j[apart]
            np.minimum.at(self.label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while not np.array_equal(up := self.label[self.label], self.label):
                self.label = up

    def runs(self) -> np.ndarray:
        """Rising numbers that two rows share iff all rows between them have one label."""
        return np.concatenate([[0], np.cumsum(self.label[1:] != self.label[:-1])])


def trie_pairs(bucket: np.ndarray, fp: np.ndarray, budget: int, labels: Labels, leaf: int = 1, tally: dict[str, int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of one bucket whose fingerprints differ in at most ``budget`` bits, but for those of one label.

    Rows are ordered by bucket and unsigned fingerprint, so a trie node is a range of rows. Node pairs of at most
    ``leaf`` combinations are compared bit by bit at once. ``tally`` counts node pairs that were split, pruned and
    compared. The caller may link labels between two steps; what they join is no longer traversed.
    """
    n = len(fp)
    tally = {} if tally is None else tally
    ones: dict[int, np.ndarray] = {}

    def count(what: str, k: int) -> None:
        tally[what] = tally.get(what, 0) + k

    def before(level: int) -> np.ndarray:
        """Ones at the level's bit before each row."""
        if level not in ones:
            if len(ones) > 16:
                ones.clear()
            ones[level] = np.concatenate([[0], np.cumsum((fp >> np.uint64(63 - level)) & np.uint64(1), dtype=np.int64)])
        return ones[level]

    def leaves(pairs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Compare all rows of small node pairs."""
        sizes = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        if sizes.max() > FRONTIER:  # many rows of one fingerprint: a few of them at a time
            cut = [(s, min(s + step, p[1]), *p[2:]) for p in pairs.tolist() for step in [max(1, FRONTIER // (p[3] - p[2]))] for s in range(p[0], p[1], step)]
            pairs = np.array(cut, np.int64)
            sizes = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        parts = np.searchsorted(np.cumsum(sizes), np.arange(FRONTIER, sizes.sum(), FRONTIER))
        for part in np.split(pairs, parts):
            a_lo, a_hi, b_lo, b_hi, _ = part.T
            wide = b_hi - b_lo
            size = (a_hi - a_lo) * wide
            k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            w = np.repeat(wide, size)
            i, j = np.repeat(a_lo, size) + k // w, np.repeat(b_lo, size) + k % w
            ok = (i < j) & (labels.label[i] != labels.label[j])
            i, j = i[ok], j[ok]
            ok = np.bitwise_count(fp[i] ^ fp[j]) <= budget
            if ok.any():
                yield i[ok], j[ok]

    def expand(pairs: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        while len(pairs):
            if len(pairs) > FRONTIER:
                for part in np.array_split(pairs, ceil(len(pairs) / FRONTIER * 2)):
                    yield from expand(part, level)
                return
            run = labels.runs()
            a_lo, a_hi, b_lo, b_hi, d = pairs.T
            joined = (run[a_lo] == run[a_hi - 1]) & (run[b_lo] == run[b_hi - 1]) & (labels.label[a_lo] == labels.label[b_lo])
            keep = ~joined & (d <= budget)
            count("pruned", int(len(pairs) - keep.sum()))
            pairs = pairs[keep]
            a_lo, a_hi, b_lo, b_hi, d = pairs.T
            small = (a_hi - a_lo) * (b_hi - b_lo) <= leaf
            if level == 64:
                small[:] = True
            if small.any():
                count("compared", int(small.sum()))
                yield from leaves(pairs[small])
            pairs = pairs[~small]
            if not len(pairs):
                return
            count("split", len(pairs))
            a_lo, a_hi, b_lo, b_hi, d = pairs.T
            c = before(level)
            a_mid, b_mid = a_hi - (c[a_hi] - c[a_lo]), b_hi - (c[b_hi] - c[b_lo])
            own = a_lo == b_lo
            made = [np.stack(x, axis=1) for x in ((a_lo, a_mid, b_lo, b_mid, d), (a_mid, a_hi, b_mid, b_hi, d), (a_lo, a_mid, b_mid, b_hi, d + 1))]
            made.append(np.stack((a_mid, a_hi, b_lo, b_mid, d + 1), axis=1)[~own])
            pairs = np.concatenate(made)
            pairs = pairs[(pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3])]
            level += 1

    starts = np.flatnonzero(np.concatenate([[n > 0], bucket[1:] != bucket[:-1]]))
    ends = np.concatenate([starts[1:], [n]])
    many = ends - starts > 1
    lo, hi = starts[many], ends[many]
    yield from expand(np.stack([lo, hi, lo, hi, np.zeros_like(lo)], axis=1), 0)


def trie_self_join(bucket: np.ndarray, fp: np.ndarray, budget: int, tally: dict[str, int] | None = None) -> np.ndarray:
    """Component label of each row (the least row), linking rows of one bucket within ``budget`` bits.

    Rows are ordered by bucket and unsigned fingerprint.
    """
    labels = Labels(len(fp))
    if len(fp) > 1:
        at = np.flatnonzero((bucket[1:] == bucket[:-1]) & (np.bitwise_count(fp[1:] ^ fp[:-1]) <= budget))
        labels.link(at, at + 1)
        for i, j in trie_pairs(bucket, fp, budget, labels, tally=tally):
            labels.link(i, j)
    return labels.label


def bucket_key(fp: Column, blocks: list[tuple[int, int]], table: int, cell: Column | None = None) -> Column:
    bits = [F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in blocks]
    return F.xxhash64(F.lit(table), *bits, *([] if cell is None else [cell]))


def dealt(fps: DataFrame, budget: int, n_blocks: int) -> DataFrame:
    """Rows (fp, bucket): each fingerprint in one bucket of every choice of blocks."""
    edges = [64 * i // n_blocks for i in range(n_blocks + 1)]
    spans = list(zip(edges, edges[1:], strict=False))
    keys = [bucket_key(F.col("fp"), list(c), t) for t, c in enumerate(combinations(spans, n_blocks - budget))]
    return fps.select("fp", F.explode(F.array(*keys)).alias("bucket"))


def link_fingerprints(fps: DataFrame, budget: int = 4, n_blocks: int = 5) -> DataFrame:
    """Edges (src, dst) that join the components of distinct fingerprints ``fp`` at ``budget`` differing bits."""
    rows = dealt(fps, budget, n_blocks)
    hot = materialize(rows.groupBy("bucket").count().where(F.col("count") > BUCKET), "simhash-hot")
    n_hot = hot.count()
    if n_hot:
        parts = F.ceil(F.col("count") / BUCKET).cast("int")
        mine = F.pmod(F.xxhash64("fp", F.lit(7)), parts).cast("int")
        cells = F.transform(F.sequence(F.lit(0), parts - 1), lambda j: F.xxhash64("bucket", F.least(j, mine), F.greatest(j, mine)))
        joined = rows.join(F.broadcast(hot) if n_hot <= 100_000 else hot, "bucket", "left")
        rows = joined.select("fp", F.explode(F.when(F.col("count").isNull(), F.array("bucket")).otherwise(cells)).alias("bucket"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def solve(chunk: np.ndarray) -> pa.RecordBatch:
            fp = chunk[1].view(np.uint64)
            same = np.concatenate([[False], chunk[0][1:] == chunk[0][:-1], [False]])
            keep = same[1:] | same[:-1]
            bucket, fp = chunk[0][keep], fp[keep]
            order = np.lexsort((fp, bucket))
            bucket, fp = bucket[order], fp[order]
            label = trie_self_join(bucket, fp, budget)
            moved = np.flatnonzero(label != np.arange(len(label)))
            signed = fp.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[label[moved]])], names=["src", "dst"])

        for batch in batches:
            held.append(np.stack([batch.column("bucket").to_numpy(), batch.column("fp").to_numpy()]))
            size += batch.num_rows
            if size >= CHUNK:
                chunk = np.concatenate(held, axis=1)
                cut = int(np.searchsorted(chunk[0], chunk[0][-1]))
                held, size = [chunk[:, cut:]], chunk.shape[1] - cut
                if cut:
                    yield solve(chunk[:, :cut])
        if held:
            yield solve(np.concatenate(held, axis=1))

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "src long, dst long")


def blocks_for(n: int) -> int:
    """More blocks give longer bucket keys (about 13, 21, 27 and 32 bits) and more tables: some dozens a bucket."""
    return 5 if n < 1_000_000 else 6 if n < 200_000_000 else 7 if n < 10_000_000_000 else 8


def near_duplicates(docs: DataFrame, shingle_words: int = 4, budget: int = 4, n_blocks: int | None = None) -> DataFrame:
    """Fingerprint and component of each document: rows (doc_id long, fp long, component_id long), as many as ``docs`` has.

    Words are separated by ASCII white space after lower-casing A-Z; fewer words than a shingle are one shingle.
    Fingerprints of at most ``budget`` differing bits are linked; component_id is the least doc_id reachable through
    links, the document's own included. Null, empty and blank texts have fingerprint zero and are linked like any
    other. Rows that share a doc_id each keep their own fingerprint. Null doc_ids never give a component_id (it is
    null where no member has an id). An empty table gives an empty table; other columns are ignored.
    """
    fps = materialize(fingerprints(docs, shingle_words), "simhash-fps")
    least = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")), "simhash-distinct")
    edges = link_fingerprints(least.select("fp"), budget, n_blocks or blocks_for(least.count()))
    parts = connected_components(materialize(edges, "simhash-links"), "simhash-cc").withColumnRenamed("node", "fp")
    linked = materialize(least.drop("n").join(parts, "fp"), "simhash-linked")
    own = linked.groupBy("label").agg(F.min("least_id").alias("part_id"))
    linked = linked.join(own, "label").select("fp", "part_id")
    member = materialize(least.join(linked, "fp", "left").select("fp", "n", F.coalesce("part_id", "least_id").alias("component_id")), "simhash-members")
    return with_names(fps, member, ["fp"]).select("doc_id", "fp", "component_id")  # a fingerprint of very many documents is no hot key


def keep_first(docs: DataFrame, shingle_words: int = 4, budget: int = 4) -> DataFrame:
    """The rows of ``docs`` whose doc_id is its component's id: one document of each group of near copies.

    Columns stay as they are. Rows with a null doc_id stay; of rows that share both doc_id and text all stay (they
    are one document). Rows that share a doc_id but not the text stay if that id leads any of their components.
    """
    gone_id = free_name(docs, "gone_id")
    found = near_duplicates(docs, shingle_words, budget)
    gone = found.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("leads")).where("not leads")
    gone = gone.select(F.col("doc_id").alias(gone_id))
    return docs.join(gone, F.col("doc_id") == F.col(gone_id), "left_anti")
