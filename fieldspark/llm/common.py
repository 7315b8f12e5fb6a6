"""Shared pieces of the training-data operators: tables in the shared folder, Arrow maps, components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldspark.sources.tables import BROADCAST_ROWS
from fieldspark.sources.tables import written as materialize

#: Rows of one node from which it is broadcast in ``with_least``.
HUB_ROWS = 10_000
#: Rows of a batch that become Python objects at once.
SLICE = 2_000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: What drops a module's caches that a Python worker keeps between tasks.
KEPT_BY_WORKER: dict[str, Callable[[], None]] = {}


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Plans that run inside hand Arrow batches of at most ``rows`` rows to Python: fewer wide rows are held at once, on both sides."""
    was = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, was)


def free_memory() -> None:
    """Give freed memory back: Python workers live on and share the executor's memory with the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def only_caches_of(module: str) -> None:
    """Drop what this worker keeps for other modules' tasks: workers live on from one stage to the next."""
    for own, clear in KEPT_BY_WORKER.items():
        if own != module:
            clear()


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType | str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch inside the tasks, ``SLICE`` rows at a time."""

    owner = fn.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_caches_of(owner)
        free_memory()
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                yield fn(batch.slice(k, SLICE))
        free_memory()

    return df.mapInArrow(run, schema)


def with_least(rows: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """``rows`` (u, v) with ``m`` of their ``u`` from ``least`` (u, m, n): no node's rows meet in one task.

    Few nodes (``n`` bounds them) are broadcast. Else the nodes of many rows are (their number is bounded by the rows
    over HUB_ROWS), and the others meet by a shuffle.
    """
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(least.select("u", "m")), "u")
    hubs = least.where(F.col("n") > HUB_ROWS).select("u", "m")
    if hubs.count() > BROADCAST_ROWS:
        return rows.join(least.select("u", "m"), "u")
    others = least.where(F.col("n") <= HUB_ROWS).select("u", "m")
    by_hub = rows.join(F.broadcast(hubs), "u")
    return by_hub.unionByName(rows.join(F.broadcast(hubs.select("u")), "u", "left_anti").join(others, "u"))


def connected_components(edges: DataFrame, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph given as ``(src, dst)`` longs: rows ``(node, label)`` with the least node as label.

    Alternates large-star and small-star rounds (Kiveris et al. 2014); each round is two keyed aggregations and joins
    on a table in the shared folder, so nothing is gathered on the driver. Self loops and repeated edges are allowed.
    A star's centre is no hot key: its rows are aggregated before they move, and meet its least node by broadcast.
    """
    tally = (F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v")))
    edges = materialize(edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), name)
    state, n = None, edges.count()
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        least = least if n <= BROADCAST_ROWS // 2 else materialize(least, name)
        large = with_least(both.where("v > u"), least, 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), name)
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        least = least if n <= BROADCAST_ROWS // 2 else materialize(least, name)
        small = with_least(large, least, 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), name)
        seen = tuple(edges.agg(*tally).first())
        if state == seen:
            break
        state, n = seen, max(n, seen[0])
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
