"""Block naming: identities against plain comparison, forced key collisions, hubs, odd rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fieldspark.llm import naming

LOWER = str.maketrans(naming.UPPER, naming.LOWER)


def plain(rows):
    """{(doc_id, sha): [(keep_id, size, kept), ...]} of rows (doc_id, text)."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    out = {}
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            out.setdefault((i, hashlib.sha256(text.encode()).hexdigest()), []).append((keep, len(ids), kept))
    return {k: sorted(v, key=str) for k, v in out.items()}


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.doc_id, r.text_sha256), []).append((r.keep_id, r.group_size, r.kept))
    return {k: sorted(v, key=str) for k, v in out.items()}


def made_rows(n=300):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("abAB") for _ in range(rnd.choice([0, 1, 7, 8, 9, 16, 17, 31, 33]))) for _ in range(40)]
    texts += [None, "", "ÄB", "äb", "Äb", "x" * 1000, "x" * 999, "x" * 1000 + "y", "\0", "\0\0"]
    return [(i, rnd.choice(texts)) for i in range(n)]


@pytest.mark.parametrize("size", [1, 8, 1024])
def test_groups_are_equal_texts(spark, size):
    rows = made_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(naming.exact_groups(df, size)) == plain(rows)


def test_shared_keys_draw_another_salt(spark):
    rows = [(i, t) for i, t in enumerate(["aaaa", "bbbb", "aaaabbbb", "bbbbaaaa", "aaaa"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    few = naming.named_blocks(df, 4, 0, 1)
    assert few.count() == 2
    assert found(naming.exact_groups(df, 4, bits=2)) == plain(rows)
    many = spark.range(40).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    with pytest.raises(RuntimeError, match="shared a key"):
        naming.identities(many, 4, bits=1)


@pytest.mark.parametrize("few, hub", [(0, 3), (10, 20), (1000, 1000)])
def test_frequent_names(spark, monkeypatch, few, hub):
    monkeypatch.setattr(naming, "FEW_NAMES", few)
    monkeypatch.setattr(naming, "HUB_ROWS", hub)
    rows = made_rows(120) + [(1000 + i, "The Same words" * 3) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(naming.exact_groups(df, 8)) == plain(rows)


def test_odd_rows(spark):
    rows = [(1, "A"), (1, "a"), (1, "a"), (None, "a"), (None, None), (None, ""), (2, None), (3, "b"), (3, "c"), (4, "w" * 300_000), (5, "W" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("rid", "sha", "keys", "n", "name", "level", "pos", "a", "gone_id")})
    out = found(naming.exact_groups(df))
    assert out == plain(rows)
    assert sum(k for v in out.values() for _, _, k in v) == 5
    kept = naming.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, (r.text or "")[:1]) for r in kept.select("doc_id", "text").collect()) == [(1, "A"), (1, "a"), (1, "a"), (2, ""), (3, "b"), (3, "c"), (5, "W")]
    empty = df.where("false")
    assert naming.exact_groups(empty).count() == 0 and naming.keep_one(empty).count() == 0
    blank = spark.createDataFrame([(None, None)] * 3, "doc_id long, text string")
    assert [(r.keep_id, r.group_size) for r in naming.exact_groups(blank).collect()] == [(None, 3)] * 3


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = naming.exact_groups(df)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
