"""Near copies by SimHash candidates and exact Jaccard similarity of word shingles.

A fingerprint of all bits can't be searched at the distance that a similarity of 0.8 means (15 % of the bits), so a
shared shingle deals the documents to buckets: two sets of similarity ``t`` share one of the first n - ceil(t n) + 1
members of each in any common order. The order is by hash with frequent members last; it decides the cost only. More
than ``prefix_members`` aren't needed: for none of so many to be shared, the least ones of the union must all be in one
set alone, for which the chance is 1 - t a member, four in a billion in all (at 0.8 twelve members). Inside a bucket the
trie self-join of ``simhash`` gives the pairs within ``bit_budget`` differing bits, and the pairs are verified on the
shingle hashes themselves. Both bounds follow from the threshold. Few shingles make bits a poor guide, so pairs of sets
of at most ``SHORT`` are verified whatever their bits.

Equal sets are one node. A large bucket first meets its hubs only, the members nearest to its bitwise majority. What
is left between components is compared inside the bucket's task, where the sets travel along, by the trie again; it
gives a link for each member that joins another component, never all pairs. A group of variants that resemble one
another by less than the threshold still costs its task a comparison for each pair within the budget, or of short sets for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import BROADCAST_ROWS, arrow_map, batches_of, connected_components, free_memory, free_name, materialize
from fieldspark.llm.simhash import BUCKET, Labels, trie_pairs

#: Members of a bucket up to which all its pairs are candidates at once; hubs of a larger one.
SMALL, HUBS = 32, 8
#: Rows of an Arrow batch with whole shingle sets, and with texts.
SETS, TEXTS = 500, 2_000
#: Frequent members put last in the order (any number gives the same result).
FREQUENT = 100_000
#: Shingles up to which a set is short.
SHORT = 32
#: Chance that no prefix member is shared, and standard deviations of the differing bits that the budget allows.
MISS, DEVIATIONS = 4.1e-9, 5.0
MIX = np.uint64(0x9E3779B97F4A7C15)


def bit_budget(threshold: float) -> int:
    """Differing bits of candidates. Sets of similarity t have a cosine of at least 2t / (1 + t), so a bit differs with a chance of acos(..) / pi at most.

    At 0.8 that is 0.152, 9.7 of 64 bits with a standard deviation of 2.9; more than 24 have a chance of about one in a million.
    """
    p = acos(min(1.0, 2 * threshold / (1 + threshold))) / pi
    return min(64, round(64 * p + DEVIATIONS * sqrt(64 * p * (1 - p))))


def prefix_members(threshold: float) -> int:
    """Members of a prefix that are enough: none of them is shared with a chance of ``MISS``."""
    return max(1, ceil(log(MISS) / log(max(1 - threshold, MISS)) - 1e-3))


def shingle_hashes(text: bytes | None, n: int) -> np.ndarray:
    """Rising distinct hashes of the runs of ``n`` words; fewer words are one run, none are none. Words as in ``simhash``."""
    words = (text or b"").lower().split()
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if len(w) < n:
        return np.array([xxhash.xxh64_intdigest(w.tobytes())], np.uint64) if len(w) else w
    m = len(w) - n + 1
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h = (h ^ w[k : k + m]) * MIX
        h ^= h >> np.uint64(29)
    return np.unique(h)


def signature(h: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(h.tobytes())


def majority(h: np.ndarray) -> int:
    """SimHash of the set: a bit is set if over half the members set it."""
    if not len(h):
        return 0
    ones = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def prefix(h: np.ndarray, threshold: float) -> np.ndarray:
    return h[: min(prefix_members(threshold), len(h) - ceil(len(h) * threshold - 1e-9) + 1)]


def among(h: np.ndarray, rising: np.ndarray) -> np.ndarray:
    return rising[np.minimum(np.searchsorted(rising, h), len(rising) - 1)] == h


def signed(x: list[int]) -> pa.Array:
    return pa.array(np.array(x, np.uint64).view(np.int64))


def lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate([np.empty(0, np.uint64), *parts]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def sketches(docs: DataFrame, threshold: float, n: int) -> DataFrame:
    """Rows (doc_id, sig, size, fp, pre): its set's identity, size, fingerprint and prefix by hash of each document's shingle set."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_hashes(t, n) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        columns = [signed([signature(h) for h in sets]), pa.array([len(h) for h in sets], pa.int32()), signed([majority(h) for h in sets]), lists([prefix(h, threshold) for h in sets])]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "sig", "size", "fp", "pre"])

    return arrow_map(docs, one, "doc_id long, sig long, size int, fp long, pre array<long>")


def of_some(docs: DataFrame, ids: DataFrame, n: int, frequent: np.ndarray | None, threshold: float) -> DataFrame:
    """Rows (sig, pre) of the documents in ``ids`` (doc_id): the prefix with ``frequent`` members last, or the whole set."""
    ids = materialize(ids.select("doc_id").distinct(), "near-ids")
    texts = docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "doc_id", "left_semi").select("text")
    late = None if frequent is None else docs.sparkSession.sparkContext.broadcast(frequent)

    def ordered(h: np.ndarray) -> np.ndarray:
        if late is None:
            return h
        last = among(h, late.value)
        return prefix(np.concatenate([h[~last], h[last]]), threshold)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_hashes(t, n) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        return pa.RecordBatch.from_arrays([signed([signature(h) for h in sets]), lists([ordered(h) for h in sets])], names=["sig", "pre"])

    return arrow_map(texts, one, "sig long, pre array<long>")  # repeated rows give repeated pairs only


def in_groups(batches: Iterator[pa.RecordBatch], chunk: int = 100_000) -> Iterator[np.ndarray]:
    """The columns of batches that are sorted by the first one, as whole groups of at least ``chunk`` rows."""
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
        size += batch.num_rows
        if size >= chunk:
            rows = np.concatenate(held, axis=1)
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            held, size = [rows[:, cut:]], rows.shape[1] - cut
            if cut:
                yield rows[:, :cut]
    if size:
        yield np.concatenate(held, axis=1)


def shared_buckets(rows: DataFrame) -> DataFrame:
    """Rows (h, sig, size, fp, n) of ``rows`` (h, sig, size, fp) whose h has ``n`` > 1 of them."""
    counts = materialize(rows.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > 1), "near-shared")
    return materialize(rows.join(F.broadcast(counts) if counts.count() <= BROADCAST_ROWS else counts, "h"), "near-buckets")


def in_cells(rows: DataFrame) -> DataFrame:
    """``rows`` with h and n, a bucket above ``BUCKET`` cut into cells of two of its parts each; without n."""
    parts = F.ceil(F.col("n") / BUCKET).cast("int")
    mine = F.pmod(F.xxhash64("sig", F.lit(7)), parts).cast("int")
    cells = F.transform(F.sequence(F.lit(0), parts - 1), lambda j: F.xxhash64("h", F.least(j, mine), F.greatest(j, mine)))
    return rows.select(F.explode(F.when(parts > 1, cells).otherwise(F.array("h"))).alias("h"), *[c for c in rows.columns if c not in ("h", "n")])


def tried(h: np.ndarray, fp: np.ndarray, size: np.ndarray, threshold: float, labels: Labels) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of one bucket within the bit budget, and all pairs of short sets, but for those of one label."""
    yield from trie_pairs(h, fp, bit_budget(threshold), labels, leaf=64)
    short = np.flatnonzero(size <= SHORT)
    if len(short) > 1:
        own = Labels(len(short))
        by = np.lexsort((labels.label[short], h[short]))
        at = np.flatnonzero((h[short][by][1:] == h[short][by][:-1]) & (labels.label[short][by][1:] == labels.label[short][by][:-1]))
        own.link(by[at], by[at + 1])
        for i, j in trie_pairs(h[short], fp[short], 64, own, leaf=64):
            apart = labels.label[short[i]] != labels.label[short[j]]
            yield short[i[apart]], short[j[apart]]


def candidates(rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of ``rows`` (h, sig, size, fp) in one small bucket, by the trie self-join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in in_groups(batches):
            x = x[:, np.lexsort((x[3].view(np.uint64), x[0]))]
            h, sig, size, fp = x
            for i, j in tried(h, fp.view(np.uint64), size, threshold, Labels(len(h))):
                ok = np.minimum(size[i], size[j]) >= np.maximum(size[i], size[j]) * threshold - 1e-9
                both = np.unique(np.stack([np.minimum(sig[i], sig[j])[ok], np.maximum(sig[i], sig[j])[ok]]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

    return rows.select("h", "sig", "size", "fp").repartition("h").sortWithinPartitions("h").mapInArrow(run, "a long, b long")


def shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many members of ``one`` each of ``others`` has; all are rising."""
    owner = np.repeat(np.arange(len(others)), [len(x) for x in others])
    return np.bincount(owner, weights=among(np.concatenate(others), one), minlength=len(others))


def bucket_links(rows: DataFrame, threshold: float) -> DataFrame:
    """Edges (src, dst) that join components of ``rows`` (h, sig, size, fp, label, pre: the set) inside buckets, verified."""

    def solve(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        h, sig, fp, label = (t[c].to_numpy() for c in ("h", "sig", "fp", "label"))
        pre = t["pre"].chunk(0) if t["pre"].num_chunks else t["pre"].combine_chunks()
        values, size = pre.flatten().to_numpy().view(np.uint64), pre.value_lengths().to_numpy().astype(np.int64)
        begin = np.cumsum(size) - size
        order = np.lexsort((fp.view(np.uint64), h))
        h, sig, fp, label, size, begin = (x[order] for x in (h, sig, fp, label, size, begin))
        labels = Labels(len(h))
        by = np.lexsort((label, h))
        at = np.flatnonzero((h[by][1:] == h[by][:-1]) & (label[by][1:] == label[by][:-1]))
        labels.link(by[at], by[at + 1])
        before = labels.label.copy()
        for i, j in tried(h, fp.view(np.uint64), size, threshold, labels):
            ok = np.minimum(size[i], size[j]) >= np.maximum(size[i], size[j]) * threshold - 1e-9
            i, j = i[ok], j[ok]
            by = np.argsort(i, kind="stable")
            i, j = i[by], j[by]
            cuts = np.flatnonzero(i[1:] != i[:-1]) + 1
            for part in np.split(j, cuts) if len(j) else []:
                one = i[0]
                i = i[len(part) :]
                part = part[labels.label[part] != labels.label[one]]
                for k in range(0, len(part), 1000):
                    some = part[k : k + 1000]
                    common = shared(values[begin[one] : begin[one] + size[one]], [values[begin[x] : begin[x] + size[x]] for x in some])
                    near = some[common >= threshold * (size[one] + size[some] - common) - 1e-9]
                    if len(near):
                        labels.link(np.full(len(near), one), near)
        moved = np.flatnonzero(labels.label != before)
        return pa.RecordBatch.from_arrays([pa.array(sig[moved]), pa.array(sig[labels.label[moved]])], names=["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch], chunk: int = 20_000) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= chunk:
                t = pa.Table.from_batches(held)
                h = t["h"].to_numpy()
                cut = int(np.searchsorted(h, h[-1]))
                if cut:
                    yield solve(t.slice(0, cut))
                held, size = t.slice(cut).to_batches(), len(h) - cut
        if size:
            yield solve(pa.Table.from_batches(held))
        free_memory()

    columns = ["h", "sig", "fp", "label", "pre"]
    return in_cells(rows).select(*columns).repartition("h").sortWithinPartitions("h").mapInArrow(run, "src long, dst long")


def hub_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of each bucket's members with its hubs: of each eighth the member nearest to the bitwise majority."""
    bits = [F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1)) for b in range(64)]
    half = rows.groupBy("h").agg(F.count("*").alias("m"), *[F.sum(x).alias(f"b{b}") for b, x in enumerate(bits)])
    centre = sum((F.when(2 * F.col(f"b{b}") > F.col("m"), F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0)) for b in range(1, 64)), F.when(2 * F.col("b0") > F.col("m"), 1).otherwise(0).cast("long"))
    centre = materialize(half.select("h", centre.alias("centre")), "near-centres")
    near = rows.join(F.broadcast(centre) if centre.count() <= BROADCAST_ROWS else centre, "h").withColumn("far", F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))))
    hub = near.groupBy("h", F.pmod(F.xxhash64("sig"), F.lit(HUBS)).alias("eighth")).agg(F.min(F.struct("far", "sig", "size", "fp")).alias("hub"))
    hub = materialize(hub.select("h", F.col("hub.sig").alias("hub"), F.col("hub.size").alias("hub_size"), F.col("hub.fp").alias("hub_fp")), "near-hubs")
    met = rows.join(F.broadcast(hub) if hub.count() <= BROADCAST_ROWS // 2 else hub, "h")
    near_bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("hub_fp"))) <= bit_budget(threshold)
    close = (F.col("sig") != F.col("hub")) & (near_bits | (F.greatest("size", "hub_size") <= SHORT))
    alike = F.least("size", "hub_size") >= F.greatest("size", "hub_size") * threshold - 1e-9
    return met.where(close & alike).select(F.least("sig", "hub").alias("a"), F.greatest("sig", "hub").alias("b"))


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose shingle sets (sig, pre) have a Jaccard similarity of at least ``threshold``, as edges (src, dst)."""
    both = pairs.join(sets.select(F.col("sig").alias("b"), F.col("pre").alias("y")), "b").join(sets.select(F.col("sig").alias("a"), F.col("pre").alias("x")), "a")

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        ok = []
        columns = []
        for c in ("x", "y"):
            at = batch.column(c)
            columns.append((at.flatten().to_numpy(), np.cumsum([0, *at.value_lengths().to_pylist()])))
        (x, xe), (y, ye) = columns
        for i in range(batch.num_rows):
            p, q = x[xe[i] : xe[i + 1]].view(np.uint64), y[ye[i] : ye[i + 1]].view(np.uint64)
            p, q = (p, q) if len(p) <= len(q) else (q, p)
            at = np.searchsorted(q, p)
            common = int((q[np.minimum(at, len(q) - 1)] == p).sum()) if len(p) else 0
            ok.append(common >= threshold * (len(p) + len(q) - common) - 1e-9)
        out = batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
        return pa.RecordBatch.from_arrays(out.columns, names=["src", "dst"])

    with batches_of(pairs.sparkSession, SETS):
        return materialize(arrow_map(both.select("a", "b", "x", "y"), check, "src long, dst long"), "near-links")


def near_copies(docs: DataFrame, threshold: float = 0.8, shingle_words: int = 5) -> DataFrame:
    """Rows (doc_id, component_id): components of the links between sets of Jaccard similarity of at least ``threshold``.

    Words are separated by ASCII white space after lower-casing A-Z; fewer words than a shingle are one shingle. Null,
    empty and blank texts have the empty set and are copies of one another, of nothing else. Rows with a null doc_id
    take no part; rows that share a doc_id count each with their own text. component_id is the least doc_id reachable
    (ties don't arise). An empty table gives an empty table; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    with batches_of(docs.sparkSession, TEXTS):
        own = materialize(sketches(docs, threshold, shingle_words).withColumn("row", F.monotonically_increasing_id()), "near-sketches")
    least = own.groupBy("sig").agg(F.min(F.struct("doc_id", "row")).alias("x")).select("sig", F.col("x.doc_id").alias("least_id"), "x.row")
    least = materialize(least, "near-distinct")
    least = F.broadcast(least) if least.count() <= BROADCAST_ROWS else least
    nodes = materialize(own.drop("doc_id").join(least, ["sig", "row"]).select("sig", "least_id", F.col("size").cast("long").alias("size"), "fp", "pre"), "near-nodes")
    least = nodes.select("sig", "least_id")
    often = nodes.select(F.explode("pre").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > SMALL)
    often = np.array([r.h for r in often.orderBy(F.desc("n"), "h").limit(FREQUENT).collect()], np.int64)
    often = np.sort(often.view(np.uint64))
    listed = lambda d: d.select(F.explode("pre").alias("h"), "sig", "size", "fp")
    rows = listed(nodes)
    if len(often):
        shared = docs.sparkSession.sparkContext.broadcast(often)

        def holds(batch: pa.RecordBatch) -> pa.RecordBatch:
            lengths = batch.column("pre").value_lengths().to_numpy()
            hit = np.bincount(np.repeat(np.arange(len(lengths)), lengths), weights=among(batch.column("pre").flatten().to_numpy().view(np.uint64), shared.value), minlength=len(lengths))
            return pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(hit > 0)], names=["sig", "again"])

        again = materialize(arrow_map(nodes.select("sig", "pre"), holds, "sig long, again boolean").where("again").select("sig"), "near-again")
        again = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
        late = of_some(docs, least.join(again, "sig").select(F.col("least_id").alias("doc_id")), shingle_words, often, threshold)
        with batches_of(docs.sparkSession, TEXTS):
            late = materialize(late.join(again, "sig").dropDuplicates(["sig"]), "near-late")
        late = late.join(nodes.drop("pre"), "sig")
        rows = listed(nodes.join(again, "sig", "left_anti")).unionByName(listed(late))
    buckets = shared_buckets(rows)

    def sets_of(sigs: DataFrame) -> DataFrame:
        ids = sigs.distinct().join(least, "sig").select(F.col("least_id").alias("doc_id"))
        with batches_of(docs.sparkSession, SETS):
            return materialize(of_some(docs, ids, shingle_words, None, threshold), "near-sets")

    large = buckets.where(F.col("n") > SMALL)
    pairs = candidates(buckets.where(F.col("n") <= SMALL), threshold)
    pairs = materialize(pairs.unionByName(hub_pairs(large, threshold)).distinct(), "near-pairs")
    links = verified(pairs, sets_of(pairs.select(F.explode(F.array("a", "b")).alias("sig"))), threshold)
    parts = materialize(connected_components(links, "near-cc").withColumnRenamed("node", "sig"), "near-parts")
    left = materialize(large.join(parts, "sig", "left").withColumn("label", F.coalesce("label", "sig")), "near-left")
    mixed = left.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("h")
    rest = materialize(left.join(mixed, "h"), "near-rest")
    wide = rest.join(sets_of(rest.select("sig")), "sig")
    with batches_of(docs.sparkSession, SETS):
        more = materialize(bucket_links(wide, threshold), "near-links")
    if not more.isEmpty():
        parts = materialize(connected_components(links.unionByName(more), "near-cc").withColumnRenamed("node", "sig"), "near-parts")
    named = least.join(parts, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    member = named.join(named.groupBy("label").agg(F.min("least_id").alias("component_id")), "label").select("sig", "component_id")
    return own.select("doc_id", "sig").join(materialize(member, "near-members"), "sig").select("doc_id", "component_id")


def keep_first_near(docs: DataFrame, threshold: float = 0.8, shingle_words: int = 5) -> DataFrame:
    """The rows of ``docs`` whose doc_id is its component's id; columns stay, and so do rows with a null doc_id.

    Of rows that share a doc_id all stay if that id leads any of their components.
    """
    gone_id = free_name(docs, "gone_id")
    found = near_copies(docs, threshold, shingle_words)
    gone = found.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("leads")).where("not leads")
    gone = materialize(gone.select(F.col("doc_id").alias(gone_id)), "near-gone")
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, F.col("doc_id") == F.col(gone_id), "left_anti")
