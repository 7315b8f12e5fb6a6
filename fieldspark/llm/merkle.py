"""Merkle manifest of a dataset: a tree of SHA-256 digests a group, the groups' roots under one root, proofs of all rows.

Leaves get their positions by a range-partitioned sort and the partitions' counts, so no group meets in one task. Each
level then joins its nodes with themselves on the computed sibling index (the index XOR 1 for a binary tree, the other
slots' offsets for wider ones), and the rows of slot zero emit the parents. What a node has met is its entry: its slot
and its siblings' digests. Proofs go from the top down: a node's path is its own entry and its parent's path, so each
level joins only its own nodes with those of the level above.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.llm.common import materialize
from fieldspark.llm.naming import with_names

#: Levels of joins in one plan of ``with_paths``.
LEVELS_A_PLAN = 6
#: Groups whose root and path are broadcast (about a kilobyte each).
FEW_GROUPS = 10_000


def field(column: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def group_key(column: Column) -> Column:
    """A text that orders groups bytewise with null first."""
    return F.when(column.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), column.cast("string")))


def positions(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` (a table) with ``idx``, their position in the group by ``order`` from 0, and ``n``, the group's rows.

    Rows are sorted in ranges; positions come from the ranges' counts a group. Equal rows may change places.
    """
    keys = [group, *order, "__tie"]
    laid = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = materialize(laid.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}).drop("__tie"), name)
    spans = laid.groupBy(group, "__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__from"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("__n").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = materialize(spans.select(group, "__part", F.col("__n").alias("n"), F.sum("__n").over(whole).alias("__all"), (before - F.col("__from")).alias("__shift")), name)
    out = with_names(laid, spans, [group, "__part"])
    return out.withColumns({"idx": F.col("__at") + F.col("__shift"), "n": F.col("__all")}).drop("__part", "__at", "__shift", "__all")


def linked(nodes: DataFrame, arity: int, carry: Sequence[str] = ()) -> DataFrame:
    """One level: rows (grp, n, idx, entry, parent, carry) of nodes (grp, n, idx, hash, carry).

    ``entry`` is a byte for the node's slot and the digests of its siblings from left to right; null in a group of one
    node. ``parent`` is the digest of the run's nodes, in the row of slot zero only.
    """
    slot = F.col("idx") % arity
    out, found = nodes, []
    for k in range(1, arity):
        sibling = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - slot + (slot + k) % arity
        other = nodes.select("grp", F.col("idx").alias(f"__i{k}"), F.col("hash").alias(f"__h{k}"))
        out = out.withColumn(f"__i{k}", sibling).join(other, ["grp", f"__i{k}"], "left")
        found.append(F.when(F.col(f"__h{k}").isNotNull(), F.struct(((slot + k) % arity).alias("slot"), F.col(f"__h{k}").alias("hash"))))
    row = F.array_join(F.transform(F.array_sort(F.array_compact(F.array(*found))), lambda s: s["hash"]), "")
    entry = F.when(F.col("n") > 1, F.unhex(F.concat(F.lpad(F.hex(slot), 2, "0"), row)))
    return out.select("grp", "n", "idx", entry.alias("entry"), F.when((slot == 0) & (F.col("n") > 1), digest(F.col("hash"), row)).alias("parent"), *carry)


def climb(nodes: DataFrame, arity: int, name: str, carry: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """(levels as tables, tops): the levels from the leaves up, and (grp, n_leaves, top) with each group's root."""
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("n_leaves"))
    most, levels, tops = sizes.agg(F.max("n_leaves")).first()[0] or 0, [], []
    while True:
        tops.append(nodes.where("n = 1").select("grp", F.col("hash").alias("top")))
        if levels and most <= 1:
            break
        level = materialize(linked(nodes if not levels else nodes.where("n > 1"), arity, carry if not levels else ()), name)
        levels.append(level)
        nodes = level.where("parent IS NOT NULL").select("grp", F.ceil(F.col("n") / arity).alias("n"), F.floor(F.col("idx") / arity).alias("idx"), F.col("parent").alias("hash"))
        most = -(-most // arity)
    return levels, materialize(sizes.join(reduce(DataFrame.unionByName, tops), "grp"), name)


def with_paths(levels: Sequence[DataFrame], arity: int, name: str) -> DataFrame:
    """The rows of the lowest level with ``path``: their entries from the lowest level up."""
    none = F.array().cast("array<binary>")
    own = F.when(F.col("entry").isNull(), none).otherwise(F.array("entry"))
    above = levels[-1].withColumn("path", own)
    for k, level in enumerate(reversed(levels[:-1]), 1):
        if k % LEVELS_A_PLAN == 0:
            above = materialize(above.select("grp", "idx", "path"), name)
        rest = above.select("grp", F.col("idx").alias("__up"), F.col("path").alias("__rest"))
        joined = level.withColumn("__up", F.floor(F.col("idx") / arity)).join(rest, ["grp", "__up"], "left")
        above = joined.withColumn("path", F.concat(own, F.coalesce("__rest", none))).drop("__up", "__rest")
    return above.drop("entry", "parent")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""

    def step(done: Column, entry: Column) -> Column:
        left = F.conv(F.hex(F.substring(entry, 1, 1)), 16, 10).cast("int") * 32
        text = lambda start, length: F.lower(F.hex(F.substring(entry, start, length)))
        return F.sha2(F.concat(text(F.lit(2), left), done, text(left + 2, F.octet_length(entry))), 256)

    return F.aggregate(path, leaf, step)


def proof_digest(path: Column) -> Column:
    """Digest of a path's sibling digests, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda e: F.lower(F.hex(F.substring(e, 2, F.octet_length(e))))), ""), 256)


@dataclass(frozen=True)
class Manifest:
    """groups: rows (grp, n_leaves, subroot, path) with the path from the group's root to ``root``; levels: of the groups' trees."""

    groups: DataFrame
    levels: list[DataFrame]
    root: str | None
    arity: int

    def proofs(self) -> DataFrame:
        """Rows (carried columns, grp, idx, subroot, path) of all leaves; the path leads to ``root``."""
        rows = with_paths(self.levels, self.arity, "merkle-paths").withColumnRenamed("path", "__low")
        tops = self.groups.select("grp", "subroot", F.col("path").alias("__high"), F.col("n_leaves").alias("n"))
        out = with_names(rows.drop("n"), tops, ["grp"], few=FEW_GROUPS)
        return out.withColumn("path", F.concat("__low", "__high")).drop("__low", "__high")


def manifest(rows: DataFrame, leaf: str, group: str, order: Sequence[str], carry: Sequence[str] = (), arity: int = 2) -> Manifest:
    """The trees over ``rows``: one a value of ``group`` with its leaves in order, and one over the groups' roots.

    ``leaf`` is the column of leaf digests; ``carry`` names columns that ``proofs`` returns (``leaf`` among them if
    wanted). While several nodes remain, every ``arity`` consecutive ones (the last run may have fewer, even one) become
    the digest of their concatenation; a lone leaf is its group's root. Groups ascend bytewise, null first. Rows that
    are equal in ``order`` follow by their leaf. An empty table has no group and the root null. Columns of any name may
    be carried but for grp, n, idx, hash, entry, parent, path, subroot and names that start with two underscores.
    """
    if not 2 <= arity <= 256:
        raise ValueError("arity is 2 to 256")
    view = rows.select(group_key(F.col(group)).alias("grp"), F.col(leaf).alias("hash"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], *carry)
    laid = positions(materialize(view, "merkle-leaves"), "grp", [*[f"__o{i}" for i in range(len(order))], "hash"], "merkle-laid")
    levels, tops = climb(materialize(laid.select("grp", "n", "idx", "hash", *carry), "merkle-nodes"), arity, "merkle-level", carry)
    heads = positions(tops.select(F.lit("").alias("grp"), F.col("grp").alias("__g"), "n_leaves", F.col("top").alias("hash")), "grp", ["__g"], "merkle-heads")
    heads = materialize(heads.select("grp", "n", "idx", "hash", "__g", "n_leaves", F.col("hash").alias("subroot")), "merkle-heads")
    upper, top = climb(heads, arity, "merkle-upper", ["__g", "n_leaves", "subroot"])
    groups = with_paths(upper, arity, "merkle-paths").select(F.col("__g").alias("grp"), "n_leaves", "subroot", "path")
    last = top.first()
    return Manifest(materialize(groups, "merkle-groups"), levels, last.top if last else None, arity)


def documents_manifest(docs: DataFrame, arity: int = 2) -> tuple[Manifest, DataFrame]:
    """(manifest by lang, its leaves' proofs) of ``docs`` (doc_id, source, lang, n_chars, text).

    The proofs have doc_id, leaf and ``tampered``: the leaf of the row with n_chars one larger where 7 divides the
    CRC-32 of the decimal doc_id (null n_chars and doc_ids stay), else the leaf itself. Null and empty values have
    different leaves; repeated rows are leaves of their own; other columns are ignored.
    """
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = digest(*[field(F.col(c)) for c in columns])
    changed = digest(*[field(F.try_add(F.col(c), F.lit(1)) if c == "n_chars" else F.col(c)) for c in columns])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(hit & F.col("n_chars").isNotNull(), changed).alias("tampered"))
    out = manifest(rows.withColumn("tampered", F.coalesce("tampered", "leaf")), "leaf", "lang", ["doc_id"], ["doc_id", "leaf", "tampered"], arity)
    return out, out.proofs()


def verified_documents(docs: DataFrame, arity: int = 2) -> DataFrame:
    """Rows (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one a row of ``docs``.

    ``folded_root`` is computed anew from the (tampered) leaf and the original siblings, for every row; the rest is of the
    untampered rows. See ``documents_manifest`` for nulls and repeated rows; an empty table gives an empty table.
    """
    tree, rows = documents_manifest(docs, arity)
    out = rows.select("doc_id", "leaf", "subroot", F.lit(tree.root).cast("string").alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), fold(F.col("tampered"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
