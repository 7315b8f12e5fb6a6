"""Registered queries of the library's operators."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.plans import feeds, models, series
from fieldspark.plans.catalog import ORACLE, QUERIES, VIEWS, query, with_views
from fieldspark.sources.tables import small_side, written

__all__ = ["ORACLE", "QUERIES", "feeds", "flagship", "models", "series"]


@query(
    "flagship_flag_counts",
    ", d AS (SELECT *, value - lag(value) OVER w AS d, coalesce(lag(value IS NULL) OVER w AND value IS NOT NULL, false) AS appeared FROM full_obs WINDOW w AS (PARTITION BY basin, station ORDER BY date)), q AS (SELECT basin, station, quantile_cont(d, 0.05) AS lo, quantile_cont(d, 0.95) AS hi FROM d WHERE d IS NOT NULL GROUP BY ALL) SELECT basin, station, count(*) AS n_days, count(*) FILTER (WHERE value IS NULL) AS missing, count(*) FILTER (WHERE value IS NOT NULL AND (value < 0 OR value > 90)) AS physical, count(*) FILTER (WHERE value BETWEEN 0 AND 90 AND appeared) AS appeared, count(*) FILTER (WHERE value BETWEEN 0 AND 90 AND NOT appeared AND (d < lo OR d > hi)) AS envelope FROM d JOIN q USING (basin, station) GROUP BY ALL",
    ("obs", "days", "full_obs"),
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard checks and the change envelope of every station-day, counted by station."""
    from fieldspark.operators import qa
    from fieldspark.operators.calendars import KEYS

    days = series.full(spark, sf_dir)
    rows = qa.with_steps(days).join(small_side(written(qa.envelope(days, 0.05, 0.95), "envelope")), list(KEYS))
    checks = [*qa.hard_checks(high=90.0), ("APPEARED", F.col("appeared"), 1), ("DELTA", (F.col("delta") < F.col("lo")) | (F.col("delta") > F.col("hi")), 2)]
    rows = qa.graded(rows, "static", checks)
    of = lambda code: F.count_if(F.col("reason_code") == code)
    return rows.groupBy(*KEYS).agg(F.count("*").alias("n_days"), of("MISSING").alias("missing"), of("PHYSICAL").alias("physical"), of("APPEARED").alias("appeared"), of("DELTA").alias("envelope"))
