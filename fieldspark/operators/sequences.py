"""Row-to-row operators of ordered series: differences, transitions, runs, gates and choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("basin", "station")


def by_date(keys: Sequence[str] = KEYS):
    return Window.partitionBy(*keys).orderBy("date")


def row_difference(value: Column, keys: Sequence[str] = KEYS, first_is_zero: bool = False) -> Column:
    """Change from the previous row; null on the first, or zero where a day compares with itself."""
    before = F.lag(value, 1).over(by_date(keys))
    first = F.row_number().over(by_date(keys)) == 1
    return value - (F.when(first, value).otherwise(before) if first_is_zero else before)


def null_to_value(value: Column, keys: Sequence[str] = KEYS) -> Column:
    """A value right after a null row; never on the first row."""
    return F.coalesce(F.lag(value.isNull(), 1).over(by_date(keys)) & value.isNotNull(), F.lit(False))


def long_runs(df: DataFrame, flag: str, k: int = 3, keys: Sequence[str] = KEYS, alias: str = "persistent") -> DataFrame:
    """Adds ``alias``: 1 on rows inside a run of at least ``k`` consecutive flags."""
    w = by_date(keys)
    df = df.withColumn("__start", (F.col(flag) != F.lag(flag, 1, 0).over(w)).cast("int"))
    df = df.withColumn("__run", F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    n = F.count("*").over(Window.partitionBy(*keys, "__run"))
    return df.withColumn(alias, ((F.col(flag) == 1) & (n >= k)).cast("int")).drop("__start", "__run")


def widen_lonely(flag: Column, keys: Sequence[str] = KEYS) -> Column:
    """A flag without flagged neighbours spreads to the day before and the day after."""
    w = by_date(keys)
    at = lambda n: F.lag(flag, n, 0).over(w)
    lonely = lambda n: (at(n) == 1) & (at(n + 1) == 0) & (at(n - 1) == 0)
    return F.greatest(flag, lonely(1).cast("int"), lonely(-1).cast("int"))


def with_gate(df: DataFrame, columns: Sequence[str], k: int = 3, eps: float = 0.0, keys: Sequence[str] = KEYS, alias: str = "gate") -> DataFrame:
    """Adds ``alias``: whether the mean change over the last ``k`` rows and all columns exceeds ``eps``.

    The last ``k`` rows are taken first and nulls dropped then; with fewer than two rows or no change the gate is open.
    """
    w = by_date(keys)
    changes = {f"__d{i}": F.col(c) - F.lag(c, 1).over(w) for i, c in enumerate(columns)}
    df = df.withColumns(changes)
    tail = w.rowsBetween(-(k - 2), 0)
    total = sum((F.coalesce(F.sum(d).over(tail), F.lit(0.0)) for d in changes), F.lit(0.0))
    n = sum((F.count(d).over(tail) for d in changes), F.lit(0))
    return df.withColumns({"__t": total, "__n": n}).withColumn(alias, F.when(F.col("__n") == 0, True).otherwise(F.col("__t") / F.col("__n") > eps)).drop(*changes, "__t", "__n")


def one_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group in the given order (W10, L1 with one row)."""
    return top_k(df, by, order, 1)


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group (L1)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= k).drop("__k")


def first_best(df: DataFrame, by: Sequence[str], candidate: str, score: str, order: str) -> DataFrame:
    """The candidate of greatest score; of equal ones the first in order (L2)."""
    return df.groupBy(*by).agg(F.max_by(candidate, F.struct(score, -F.col(order))).alias(candidate))


def season_order(season: Column, seasons: Sequence[str] = ("season", "accum", "melt")) -> Column:
    """A number that sorts season before accumulation before melt (L3)."""
    return F.array_position(F.array(*map(F.lit, seasons)), season)
