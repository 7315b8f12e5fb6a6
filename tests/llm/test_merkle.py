"""Merkle manifests against a plain fold, for several arities, odd rows and one hot group."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from fieldspark.llm import merkle, naming

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(level, arity):
    levels = [level]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + arity]) for i in range(0, len(last), arity)])
    return levels


def siblings(levels, i, arity):
    """[(slot, siblings from left to right)] level by level."""
    out = []
    for level in levels[:-1]:
        run, slot = level[i - i % arity : i - i % arity + arity], i % arity
        out.append((slot, [*run[:slot], *run[slot + 1 :]]))
        i //= arity
    return out


def plain(rows, arity):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((own, climb([leaf_of(r) for r in own], arity)))
    top = climb([t[1][-1][0] for t in trees], arity)
    out = []
    for g, (own, levels) in enumerate(trees):
        for i, row in enumerate(own):
            steps = siblings(levels, i, arity) + siblings(top, g, arity)
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            acc = leaf_of((*row[:3], row[3] + 1, row[4])) if hit else leaf_of(row)
            for slot, sib in steps:
                acc = H(*sib[:slot], acc, *sib[slot:])
            out.append((row[0], leaf_of(row), levels[-1][0], top[-1][0], H(*[x for _, s in steps for x in s]), acc, acc == top[-1][0]))
    return sorted(map(str, out))


def found(df):
    return sorted(str(tuple(r)) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def made(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(6)


ROWS = [(i, f"s{i % 3}", ["en", "en", "de", None, "é"][i % 5], i * 7, f"text {i} ä") for i in range(83)] + [(500, None, "lone", None, None), (None, "", "de", 3, ""), (501, "", "", 0, "x" * 200_000)]


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_trees_and_proofs(spark, arity):
    assert found(merkle.verified_documents(made(spark, ROWS), arity)) == plain(ROWS, arity)


def test_repeated_rows_and_clashing_columns(spark):
    rows = ROWS[:9] + [ROWS[0]] * 4 + [(0, "other", "en", 1, "same id")] * 2
    df = made(spark, rows).withColumns({c: F.lit(1) for c in ("grp", "idx", "n", "hash", "entry", "parent", "path", "leaf", "tampered", "subroot")})
    assert found(merkle.verified_documents(df)) == plain(rows, 2)


def test_few_groups_and_deep_plans(spark, monkeypatch):
    monkeypatch.setattr(merkle, "FEW_GROUPS", 0)
    monkeypatch.setattr(merkle, "LEVELS_A_PLAN", 2)
    monkeypatch.setattr(naming, "FEW_NAMES", 0)
    rows = [(i, "s", "en" if i else "de", i, "t") for i in range(40)]
    assert found(merkle.verified_documents(made(spark, rows))) == plain(rows, 2)


@pytest.mark.parametrize("rows", [[], [(1, "s", "en", 2, "t")], [(1, "s", None, 2, None), (2, None, "de", None, "")], [(None,) * 5] * 3])
def test_small_tables(spark, rows):
    assert found(merkle.verified_documents(made(spark, rows))) == (plain(rows, 2) if rows else [])


def test_positions_are_dense(spark):
    rows = spark.range(1000).select((F.col("id") % 3).cast("string").alias("g"), F.floor(F.col("id") / 100).alias("o"))
    out = merkle.positions(rows, "g", ["o"], "test").orderBy("g", "idx").collect()
    for g in "012":
        own = [r for r in out if r.g == g]
        assert [r.idx for r in own] == list(range(len(own))) and {r.n for r in own} == {len(own)}
        assert [r.o for r in own] == sorted(r.o for r in own)


def test_manifest_of_any_table(spark):
    rows = spark.range(10).select(F.sha2(F.col("id").cast("string"), 256).alias("leaf"), (F.col("id") % 2).alias("part"), "id")
    tree = merkle.manifest(rows, "leaf", "part", ["id"], ["id"])
    proofs = tree.proofs().select("id", merkle.fold(F.sha2(F.col("id").cast("string"), 256), F.col("path")).alias("root")).collect()
    assert {r.root for r in proofs} == {tree.root} and len(proofs) == 10
    assert {r.grp: r.n_leaves for r in tree.groups.collect()} == {"=0": 5, "=1": 5}
    with pytest.raises(ValueError, match="arity"):
        merkle.manifest(rows, "leaf", "part", ["id"], arity=1)
