"""Exact deduplication by deterministic block naming, with DataFrame functions only.

1. Texts are cut into blocks of a fixed number of bytes. The distinct blocks are sorted and numbered: a block's number
   is its name. Block contents shuffle once, combined before they move, so a thousand copies send one block a task.
2. A document's names are paired with their neighbours; the distinct pairs are sorted and numbered again, and so on
   until each document has one name. Two documents are equal iff they end on the same level with the same name.

Rows find the names of their blocks by a key of two 64-bit hashes instead of the content. That the keys separate all
distinct blocks of the input is checked on the blocks themselves; if two blocks ever shared a key, all keys would be
drawn again with another salt. So a name never stands for two contents. Names of pairs need no hash.

Many rows may share one block, pair or identity: names of more than ``HUB_ROWS`` rows (few, as rows bound them) reach
their rows by broadcast, the others by a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import HUB_ROWS, free_name, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_BYTES = 1024
#: Names up to which all of them are broadcast.
FEW_NAMES = 100_000


def normalised(text: Column) -> Column:
    """The bytes that decide: A-Z lower-cased, null as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER).cast("binary")


def block_at(data: Column, i: Column, size: int) -> Column:
    return F.substring(data, i * size + 1, F.lit(size))


def block_numbers(data: Column, size: int) -> Column:
    """0 to the last block's number; empty data have one empty block."""
    return F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.octet_length(data) / size).cast("int") - 1))


def block_key(block: Column, salt: int, bits: int) -> list[Column]:
    """Two hashes of ``bits`` bits."""
    return [F.shiftrightunsigned(F.xxhash64(F.lit(f"{side}{salt}"), block), 64 - bits) for side in "ab"]


def keyed_documents(docs: DataFrame, size: int, salt: int, bits: int) -> DataFrame:
    """Rows (rid, doc_id, sha, keys): a number a row, the digest of the normalised text, the keys of its blocks in order."""

    def of(data: Column) -> Column:
        keys = F.transform(block_numbers(data, size), lambda i: F.struct(*[k.alias(c) for k, c in zip(block_key(block_at(data, i, size), salt, bits), "ab", strict=True)]))
        return F.struct(F.sha2(data, 256).alias("sha"), keys.alias("keys"))

    # the lambda binds the normalised text once a row
    view = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.array(normalised(F.col("text"))).alias("data"))
    return materialize(view.select("rid", "doc_id", F.inline(F.transform("data", of))), "naming-docs")


def named(distinct: DataFrame, by: Sequence[str], columns: Sequence[Column | str], name: str) -> DataFrame:
    """Distinct rows (by, n) sorted and numbered: (columns, n, name), as a table, so that the numbers are fixed."""
    return materialize(distinct.sortWithinPartitions(*by).select(*columns, "n", F.monotonically_increasing_id().alias("name")), name)


def named_blocks(docs: DataFrame, size: int, salt: int, bits: int) -> DataFrame:
    """Rows (a, b, n, name) of all distinct blocks: the block's key, how many rows have it, its name."""
    data = docs.select(F.array(normalised(F.col("text"))).alias("data"))
    blocks = data.select(F.explode(F.get(F.transform("data", lambda d: F.transform(block_numbers(d, size), lambda i: block_at(d, i, size))), F.lit(0))).alias("block"))
    a, b = block_key(F.col("block"), salt, bits)
    return named(blocks.groupBy("block").agg(F.count("*").alias("n")), ["block"], [a.alias("a"), b.alias("b")], "naming-blocks")


def with_names(rows: DataFrame, names: DataFrame, keys: Sequence[str], few: int | None = None) -> DataFrame:
    """``rows`` with their name; no frequent name's rows meet in one task. Up to ``few`` names are broadcast."""
    keys, few = list(keys), FEW_NAMES if few is None else few
    if names.count() <= few:
        return rows.join(F.broadcast(names.drop("n")), keys)
    hubs = names.where(F.col("n") > HUB_ROWS).drop("n")
    if not 0 < hubs.count() <= few:
        return rows.join(names.drop("n"), keys)
    others = rows.join(F.broadcast(hubs.select(*keys)), keys, "left_anti").join(names.where(F.col("n") <= HUB_ROWS).drop("n"), keys)
    return rows.join(F.broadcast(hubs), keys).unionByName(others)


def identities(docs: DataFrame, size: int = BLOCK_BYTES, bits: int = 64, max_salts: int = 8) -> DataFrame:
    """Rows (rid, doc_id, sha, level, name), one a row of ``docs``: equal texts have equal (level, name), others never do.

    rid numbers the rows; sha is the hexadecimal SHA-256 of the normalised text (A-Z lower-cased, null as empty).
    """
    for salt in range(max_salts):
        blocks = named_blocks(docs, size, salt, bits)
        if blocks.groupBy("a", "b").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError(f"blocks shared a key of {2 * bits} bits with each of {max_salts} salts")
    keyed = keyed_documents(docs, size, salt, bits)
    first = keyed.select("rid", F.size("keys").alias("left"), F.posexplode("keys").alias("pos", "key")).select("rid", "left", "pos", "key.a", "key.b")
    nodes = materialize(with_names(first, blocks, ["a", "b"]).select("rid", "left", "pos", "name"), "naming-nodes")
    most, level, done = keyed.agg(F.max(F.size("keys"))).first()[0] or 1, 0, []
    while True:
        done.append(nodes.where("left = 1").select("rid", F.lit(level).alias("level"), "name"))
        if most <= 1:
            break
        side = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
        pairs = nodes.where("left > 1").groupBy("rid", F.ceil(F.col("left") / 2).cast("int").alias("left"), F.floor(F.col("pos") / 2).cast("int").alias("pos_"))
        pairs = materialize(pairs.agg(side(0).alias("x"), F.coalesce(side(1), F.lit(-1)).alias("y")).withColumnRenamed("pos_", "pos"), "naming-pairs")
        names = named(pairs.groupBy("x", "y").agg(F.count("*").alias("n")), ["x", "y"], ["x", "y"], "naming-names")
        nodes = materialize(with_names(pairs, names, ["x", "y"]).select("rid", "left", "pos", "name"), "naming-nodes")
        most, level = (most + 1) // 2, level + 1
    return materialize(keyed.select("rid", "doc_id", "sha").join(reduce(DataFrame.unionByName, done), "rid"), "naming-identities")


def exact_groups(docs: DataFrame, size: int = BLOCK_BYTES, bits: int = 64) -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one a row of ``docs``: which row of equal texts stays.

    Texts are equal when identical after lower-casing A-Z only; null counts as empty. The row of the largest doc_id
    stays; of rows that share it exactly one is marked (which one of these equal rows is arbitrary). Null doc_ids are less
    than all others; keep_id is null where a group has no other. An empty table gives an empty table; texts of any
    length have one identity; other columns are ignored.
    """
    found = identities(docs, size, bits)
    groups = found.groupBy("level", "name").agg(F.max(F.struct("doc_id", "rid")).alias("top"), F.count("*").alias("n"))
    groups = materialize(groups.select("level", F.col("name").alias("identity"), "n", F.col("n").alias("group_size"), F.col("top.doc_id").alias("keep_id"), F.col("top.rid").alias("keep_rid")), "naming-groups")
    out = with_names(found.withColumnRenamed("name", "identity"), groups, ["level", "identity"])
    return out.select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_one(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` drops; columns stay as they are.

    Rows that share both doc_id and normalised text are one document here: they stay or go together.
    """
    gone_id, gone_sha = free_name(docs, "gone_id"), free_name(docs, "gone_sha")
    rows = exact_groups(docs, size).groupBy("doc_id", "text_sha256").agg(F.bool_or("kept").alias("any_kept"))
    gone = rows.where("not any_kept").select(F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(gone_sha))
    sha = F.sha2(normalised(F.col("text")), 256)
    return docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col(gone_id)) & (sha == F.col(gone_sha)), "left_anti")
