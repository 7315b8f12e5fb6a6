"""Sensor-network views over the star-schema tables: stations' daily values, surveys by band, grids and raw feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily station values (basin, station, date, value); stations are supplier nations, with natural gaps."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("date"), "l_quantity")
    by_supplier = lines.groupBy("l_suppkey", "date").agg(F.sum("l_quantity").alias("q"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("station"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("station"), F.col("n_regionkey").alias("basin"))
    joined = by_supplier.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(nation, "station")
    return joined.groupBy("basin", "station", "date").agg(F.sum("q").alias("value"))


#: Lines of a task that sums and sorts them in memory, whatever the session's partitions are.
TASK_LINES = 500_000


def obs_wide_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``obs`` with every supplier a station of its own: a thousand at sf0.1.

    Lines are dealt by supplier, few of which share a date: days, joins and what a station is grouped for need no other shuffle.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("date"), "l_quantity")
    lines = lines.repartition(lines.count() // TASK_LINES + 1, "l_suppkey").groupBy("l_suppkey", "date").agg(F.sum("l_quantity").alias("value"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").alias("basin"))
    joined = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select("basin", F.col("l_suppkey").alias("station"), "date", "value")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly survey values by basin and band, with a ``total`` band (basin, date, band, value)."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.trunc("o_orderdate", "month").alias("date"), F.col("o_orderpriority").alias("band"), "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("basin"))
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, "c_nationkey")
    rows = rows.select("basin", "date", "o_totalprice", F.explode(F.array("band", F.lit("total"))).alias("band"))
    return rows.groupBy("basin", "date", "band").agg(F.sum("o_totalprice").alias("value"))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly cell values (date, y, x, value)."""
    lines = table(spark, sf_dir, "lineitem")
    keys = [F.trunc("l_shipdate", "month").alias("date"), F.col("l_suppkey").alias("y"), F.col("l_linenumber").cast("long").alias("x")]
    return lines.groupBy(*keys).agg(F.sum("l_quantity").alias("value"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid cells with their elevation (y, x, elev)."""
    x = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("y"), F.col("l_linenumber").cast("long").alias("x")).distinct()
    return x.join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("y"), F.col("s_acctbal").alias("elev")), "y")


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-daily sensor readings (station, sensor, ts, seq, value, props)."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("station"), F.col("event_type").alias("sensor"), "ts", F.col("event_id").alias("seq"), "value", "props")


#: Elevation bands of the example grid, edges in feet; the lowest and highest are open.
BANDS = [("<1k", float("-inf"), 1000.0), ("1k-4k", 1000.0, 4000.0), ("4k-7k", 4000.0, 7000.0), (">7k", 7000.0, float("inf"))]


def bands(spark: SparkSession, rows: list[tuple[str, float, float]] | None = None) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(rows or BANDS)]
    return spark.createDataFrame(rows, "ord int, band string, lo double, hi double")
