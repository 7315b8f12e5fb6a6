"""The near-copy stage against all pairs compared one by one."""

import random

import numpy as np
import pytest

import corpus_pipeline
from fieldspark.llm import neardup, simhash


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept(rows):
    sets = {d: shingle_set(t) for d, t in rows}
    up = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0):
                old, new = max(up[a], up[b]), min(up[a], up[b])
                up = {d: new if u == old else u for d, u in up.items()}
    return {d for d in sets if up[d] == d}


@pytest.mark.parametrize("small,hubs,bucket", [(neardup.SMALL, neardup.HUBS, neardup.BUCKET), (2, 1, 3)])
def test_near_copies_go(spark, monkeypatch, small, hubs, bucket):
    monkeypatch.setattr(neardup, "BUCKET", bucket)
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "HUBS", hubs)
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(5000)}"
    common = [word() for _ in range(12)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(3, 120))] + common
        texts.append(base)
        for edits in (0, 1, 1, 2, 3):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = word()
            texts.append(copy)
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "one"), (903, "One ")]
    out = corpus_pipeline.simhash_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    want = kept(rows)
    assert {r.doc_id for r in out.collect()} == want
    assert len(want) < len(rows) - 12


def test_stage_on_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id for r in corpus_pipeline.simhash_dedup(spark, docs, "").collect()} == kept(rows)


def test_repeated_ids_and_other_columns_stay(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long, "x"), (1, "other words altogether", "y"), (2, long + " end", "z"), (None, long, "n"), (3, None, "a"), (4, "  ", "b")]
    out = corpus_pipeline.simhash_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, gone_id string"), "")
    assert sorted(r.gone_id for r in out.collect()) == ["a", "n", "x", "y"]
    assert corpus_pipeline.simhash_dedup(spark, out.limit(0), "").count() == 0


def test_a_large_group_of_one_fingerprint(monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    fp = np.zeros(40, np.uint64)
    labels = simhash.Labels(40)
    pairs = [p for i, j in simhash.trie_pairs(np.zeros(40, np.int64), fp, 4, labels) for p in zip(i, j, strict=True)]
    assert sorted(pairs) == [(i, j) for i in range(40) for j in range(i + 1, 40)]


def test_trie_splits_and_prunes():
    rng = np.random.default_rng(5)
    fp = np.sort(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    base = fp[:40]
    fp = np.unique(np.concatenate([fp, base ^ (np.uint64(1) << rng.integers(0, 63, 40).astype(np.uint64)), base ^ np.uint64(0b11111)]))
    tally = {}
    label = simhash.trie_self_join(np.zeros(len(fp), np.int64), fp, 4, tally)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4
    want = simhash.Labels(len(fp))
    want.link(*np.nonzero(near))
    assert (label == want.label).all() and len(np.unique(label)) < len(fp)
    assert tally["split"] > 0 and tally["pruned"] > 0 and tally["compared"] < len(fp) ** 2 / 4


def test_trie_descends_on_the_corpus(spark):
    """The distinct fingerprints of a table, dealt as the operator deals them."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fps = simhash.fingerprints(docs).select("fp").distinct()
    rows = simhash.dealt(fps, 4, 5).toPandas().sort_values(["bucket", "fp"])
    order = np.lexsort((rows.fp.to_numpy().view(np.uint64), rows.bucket.to_numpy()))
    tally = {}
    simhash.trie_self_join(rows.bucket.to_numpy()[order], rows.fp.to_numpy()[order].view(np.uint64), 4, tally)
    assert tally["split"] > 0 and tally["pruned"] > 0


def test_bounds_follow_the_threshold():
    assert (neardup.bit_budget(0.8), neardup.prefix_members(0.8)) == (24, 12)
    assert neardup.bit_budget(0.4) > 30 and neardup.prefix_members(0.4) > 30 and neardup.bit_budget(1.0) == 0


def test_short_sets_are_candidates_whatever_their_bits():
    """Pairs of 8 and 9 words, four of five shingles shared: some differ in more bits than the budget."""
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, (200_000, 5), dtype=np.uint64)
    bits = ((h[:, :, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int8)
    far = np.flatnonzero(((bits.sum(axis=1) > 2.5) != (bits[:, :4].sum(axis=1) > 2)).sum(axis=1) > neardup.bit_budget(0.8))
    assert len(far)
    for k in far:
        a, b = np.sort(h[k]), np.sort(h[k, :4])
        fp = np.sort(np.array([neardup.majority(a), neardup.majority(b)], np.uint64))
        assert len(list(neardup.tried(np.zeros(2, np.int64), fp, np.array([5, 4]), 0.8, simhash.Labels(2)))) == 1


@pytest.mark.parametrize("threshold", [0.4, 0.6, 0.8, 0.9])
@pytest.mark.parametrize("small", [neardup.SMALL, 2])
def test_short_texts_at_any_threshold(spark, monkeypatch, threshold, small):
    monkeypatch.setattr(neardup, "SMALL", small)
    rng = random.Random(int(threshold * 10))
    rows = []
    for g in range(60):
        base = [f"w{rng.randrange(900)}" for _ in range(rng.choice([5, 8, 9, 12, 20, 45]))]
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.choice([0, -1, rng.randrange(len(copy))])] = f"w{rng.randrange(900)}"
            rows.append((len(rows), " ".join(copy + ["tail"] * rng.randint(0, 1))))
    sets = {d: shingle_set(t) for d, t in rows}
    up = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                old, new = max(up[a], up[b]), min(up[a], up[b])
                up = {d: new if u == old else u for d, u in up.items()}
    out = {r.doc_id: r.component_id for r in neardup.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), threshold).collect()}
    assert out == up and 60 <= len(set(out.values())) < len(rows)
