"""Calendars, resampling, gaps, splits and exclusions of daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.sources.tables import small_side, written

KEYS = ("basin", "station")


def daily_calendar(df: DataFrame, keys: Sequence[str] = KEYS, step: str = "1 day", most_days: int = 73_000) -> DataFrame:
    """Every date from the table's first to its last, for each series: gaps become null rows.

    A span over ``most_days`` (two centuries) is an error: one wrong date would make millions of rows a series.
    """
    span = df.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    series = df.select(*keys).distinct().crossJoin(F.broadcast(span))  # one row
    dates = F.when(F.date_diff("hi", "lo") > most_days, F.raise_error(F.concat(F.lit("dates span "), "lo", F.lit(" to "), "hi"))).otherwise(F.sequence("lo", "hi", F.expr(f"interval {step}")))
    days = series.select(*keys, F.explode(dates).alias("date"))
    return days.join(df, [*keys, "date"], "left")


def daily(df: DataFrame, keys: Sequence[str] = ("station",), how: str = "mean", ts: str = "ts", value: str = "value", seq: str = "seq") -> DataFrame:
    """One value a day: the mean, or the first non-null by time (A1, A3)."""
    first = F.min_by(value, F.when(F.col(value).isNotNull(), F.struct(ts, seq))) if how == "first" else F.avg(value)
    return df.groupBy(*keys, F.to_date(ts).alias("date")).agg(first.alias(value))


def monthly(df: DataFrame, keys: Sequence[str] = ("station",), how: str = "first", date: str = "date", value: str = "value") -> DataFrame:
    """One value a month, dated to its first day: first (by date), max, min or mean (A2)."""
    agg = {"first": F.min_by(value, F.when(F.col(value).isNotNull(), F.col(date))), "max": F.max(value), "min": F.min(value), "mean": F.avg(value)}[how]
    return df.groupBy(*keys, F.trunc(date, "month").alias("month")).agg(agg.alias(value))


def interpolate(df: DataFrame, keys: Sequence[str] = KEYS, value: str = "value") -> DataFrame:
    """Fills gaps between two values linearly by date; the ends stay null."""
    back = Window.partitionBy(*keys).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy("date").rowsBetween(0, Window.unboundedFollowing)
    point = F.when(F.col(value).isNotNull(), F.struct(F.col("date").alias("d"), F.col(value).alias("v")))
    a, b = F.last(point, ignorenulls=True).over(back), F.first(point, ignorenulls=True).over(ahead)
    df = df.withColumns({"__a": a, "__b": b})
    share = F.date_diff("date", "__a.d") / F.date_diff("__b.d", "__a.d")
    blend = F.col("__a.v") + (F.col("__b.v") - F.col("__a.v")) * share
    return df.withColumn(value, F.coalesce(F.col(value), blend)).drop("__a", "__b")


def water_year_slice(df: DataFrame, wy: int, closed: bool = True) -> DataFrame:
    """Rows from October 1 of the year before to October 1, which belongs to it only if ``closed`` (F1)."""
    lo, hi = F.make_date(F.lit(wy - 1), F.lit(10), F.lit(1)), F.make_date(F.lit(wy), F.lit(10), F.lit(1))
    return df.where((F.col("date") >= lo) & ((F.col("date") <= hi) if closed else (F.col("date") < hi)))


def split_rows(df: DataFrame, test_wy: int, train: str = "earlier", qa_from: str = "2013-01-01", qa_all_train: bool = False, qa_to: str = "2025-10-01") -> DataFrame:
    """Adds ``is_test``, ``is_train`` and ``is_qa`` (F2).

    Test is the water year; train all earlier rows, or all others (``train="others"``); QA from ``qa_from`` to the
    test year's start, or the train rows up to ``qa_to``. The splits are columns, so one pass serves all three.
    """
    lo, hi = F.make_date(F.lit(test_wy - 1), F.lit(10), F.lit(1)), F.make_date(F.lit(test_wy), F.lit(10), F.lit(1))
    date = F.col("date")
    test = (date >= lo) & (date < hi)
    is_train = date < lo if train == "earlier" else ~test
    since = date >= F.lit(qa_from).cast("date")
    qa = is_train & since & (date < F.lit(qa_to).cast("date")) if qa_all_train else since & (date < lo)
    return df.withColumns({"is_test": test, "is_train": is_train, "is_qa": qa})


def exclude(df: DataFrame, ranges: DataFrame, value: str = "value") -> DataFrame:
    """Null inside exclusion ranges (station, start, end), both ends included, a null end open; adds ``excluded``.

    ``ranges`` is a hand-kept list and is broadcast; overlapping ranges don't repeat rows.
    """
    r = ranges.select(
        F.col("station").alias("__s"), F.coalesce("start", F.lit("0001-01-01").cast("date")).alias("__lo"), F.coalesce("end", F.lit("9999-12-31").cast("date")).alias("__hi")
    )
    spans = small_side(written(r.groupBy("__s").agg(F.collect_list(F.struct("__lo", "__hi")).alias("__r")), "exclusions"))
    joined = df.join(spans, F.col("station") == F.col("__s"), "left")
    hit = F.coalesce(F.exists("__r", lambda x: F.col("date").between(x["__lo"], x["__hi"])), F.lit(False))
    return joined.withColumn("excluded", hit).withColumn(value, F.when(~F.col("excluded"), F.col(value))).drop("__s", "__r")


def enough_values(df: DataFrame, keys: Sequence[str] = KEYS, value: str = "value", max_missing: float = 0.5) -> DataFrame:
    """Series whose share of nulls is below the bound: (keys, missing)."""
    return df.groupBy(*keys).agg(F.avg(F.col(value).isNull().cast("double")).alias("missing")).where(F.col("missing") < max_missing)


def missing_ranking(df: DataFrame, columns: Sequence[str], k: int = 15) -> DataFrame:
    """The ``k`` columns with most nulls, in percent: one pass over the table."""
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in columns])
    return shares.unpivot([], list(columns), "column", "missing_pct").orderBy(F.desc("missing_pct"), "column").limit(k)


def display_rows(df: DataFrame, mode: str, hidden_mode: str, hide: Sequence[str], names: dict[str, str], model: str = "model") -> DataFrame:
    """Rows for display: one mode dropped, columns hidden, model names spelled out."""
    shown = F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col(model)], F.col(model))
    return df.where(F.trim(mode) != hidden_mode).withColumn(model, shown).drop(*hide)


def todo_dates(done: DataFrame, until: str) -> DataFrame:
    """Dates after the last done one up to ``until`` that the checklist lacks."""
    last = done.agg(F.max("date").alias("last"))
    days = last.where(F.col("last") < F.lit(until).cast("date")).select(F.explode(F.sequence(F.date_add("last", 1), F.lit(until).cast("date"))).alias("date"))
    return days.join(done, "date", "left_anti")


def fill_failed_days(pred: DataFrame, calendar: DataFrame, layout: Sequence[str]) -> DataFrame:
    """Every calendar date for each (model, mode, …) of the layout; days without a prediction have nulls."""
    rows = calendar.select("date").distinct().crossJoin(small_side(written(pred.select(*layout).distinct(), "layout")))  # the result has these rows
    return rows.join(pred, ["date", *layout], "left")
