"""Cleaning of raw feeds: lenient dates and numbers, sentinels, column and sensor choice, station kinds."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Readings that mean "missing" (fixed values of the feeds).
SENTINELS = (-9999.0, -999.0, -99.0)
NUMBER = r"([-+]?\d*\.?\d+)"
#: Words of a header that never name a value column (fixed values).
BLOCKED = ("date", "measured", "time", "depth", "density", "station", "id", "elev", "elevation", "lat", "lon", "long", "location", "site", "name")
#: Monthly sensors in order of preference (fixed values).
MONTHLY_PRIORITY = (76, 3, 82)


def lenient_timestamp(obs_date: Column, date: Column | None = None, time: Column | None = None) -> Column:
    """Timestamp of ``YYYYMMDD HHMM``, else of the digits alone (8 digits are a day, others are cut or padded to 12);
    else of a day padded to 8 and a time padded to 4 digits; else of anything date-like; else null (T1)."""
    digits = F.regexp_replace(obs_date, r"\D", "")
    padded = F.rpad(F.substring(digits, 1, 12), 12, "0")
    tries = [F.try_to_timestamp(F.trim(obs_date), F.lit("yyyyMMdd HHmm")), F.when(F.length(digits) >= 8, F.try_to_timestamp(padded, F.lit("yyyyMMddHHmm")))]
    if date is not None and time is not None:
        both = F.concat(F.lpad(F.trim(date), 8, "0"), F.lpad(F.trim(time), 4, "0"))
        tries.append(F.try_to_timestamp(both, F.lit("yyyyMMddHHmm")))
    tries.append(F.try_to_timestamp(date if date is not None else obs_date))
    return F.coalesce(*tries)


def plain_number(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), ",", "").try_cast("double")


def lenient_number(df: DataFrame, column: str, alias: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``alias``: the column as a number. If fewer than max(3, 10 %) of a group's rows parse, each row gives its
    first signed decimal instead (T2)."""
    plain = plain_number(F.col(column))
    counts = df.groupBy(*by).agg(F.count(plain).alias("__ok"), F.count("*").alias("__n"))
    few = F.col("__ok") < F.greatest(F.lit(3.0), F.col("__n") * 0.1)
    joined = df.join(counts, list(by)) if by else df.crossJoin(F.broadcast(counts))  # one row
    return joined.withColumn(alias, F.when(few, F.regexp_extract(column, NUMBER, 1).try_cast("double")).otherwise(plain)).drop("__ok", "__n")


def clean_value(value: Column, sentinels: Sequence[float] = SENTINELS) -> Column:
    """Null instead of sentinels and NaN."""
    return F.when(~value.isin(*sentinels) & ~F.isnan(value), value)


def header_score(name: Column) -> Column:
    """Points of a header by its words: snow water equivalent 100, W.C. 95, water content 90, value 10, others 1.

    Null if one of the words is blocked or the header starts with "unnamed".
    """
    plain = F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " "))
    words = F.split(plain, " ")
    has = lambda *parts: reduce(lambda a, b: a & b, [F.contains(plain, F.lit(p)) for p in parts])
    score = F.when(F.replace(plain, F.lit(" "), F.lit("")).isin("wc", "w"), 95).when(has("snow", "water", "equiv") | F.array_contains(words, "swe"), 100)
    score = score.when(has("water", "content"), 90).when(F.array_contains(words, "value"), 10).otherwise(1)
    return F.when(~F.arrays_overlap(words, F.array(*map(F.lit, BLOCKED))) & ~F.startswith(plain, F.lit("unnamed")), score)


def best_column(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The column of each group whose header scores best, then with most numbers, then leftmost.

    Columns without a number don't count; numbers are read as in ``lenient_number``.
    """
    rank = {c: i for i, c in enumerate(columns)}
    long = df.select(*by, *[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot(list(by), [F.col(f"`{c}`") for c in columns], "column", "text")
    order = F.create_map(*[x for c, i in rank.items() for x in (F.lit(c), F.lit(-i))])
    plain, first = F.count(plain_number(F.col("text"))), F.count(F.regexp_extract("text", NUMBER, 1).try_cast("double"))
    counts = long.groupBy(*by, "column").agg(F.when(plain < F.greatest(F.lit(3.0), F.count("*") * 0.1), first).otherwise(plain).alias("n"))
    scored = counts.withColumn("score", header_score(F.col("column"))).where("score IS NOT NULL AND n > 0")
    return scored.groupBy(*by).agg(F.max_by("column", F.struct("score", "n", order[F.col("column")].alias("o"))).alias("column"))


def prefer_sensor(df: DataFrame, keys: Sequence[str], preferred, fallback, value: str = "value") -> DataFrame:
    """The preferred sensor's value, else the fallback's, for each key."""
    of = lambda s: F.max(F.when(F.col("sensor") == s, F.col(value)))
    return df.where(F.col("sensor").isin(preferred, fallback)).groupBy(*keys).agg(F.coalesce(of(preferred), of(fallback)).alias(value))


def fullest_sensor(df: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """The sensor of each group with most non-null values; ties go to the lesser name."""
    counts = df.groupBy(*by, "sensor").agg(F.count(value).alias("n"))
    w = Window.partitionBy(*by).orderBy(F.desc("n"), "sensor")
    return counts.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def monthly_sensors(sensors: DataFrame, priority: Sequence[int] = MONTHLY_PRIORITY, k: int = 8) -> DataFrame:
    """Up to ``k`` monthly snow sensors of each station, the priority list first, then by number (C4)."""
    number = F.regexp_extract(F.col("sensor").cast("string"), r"(\d+)", 1).try_cast("int")
    rows = sensors.where(F.lower("duration").contains("month") & F.upper("kind").rlike("SNO|SWE|WATER")).withColumn("number", number).where("number IS NOT NULL")
    place = F.array_position(F.array(*map(F.lit, priority)), F.col("number"))
    w = Window.partitionBy("station").orderBy(F.when(place > 0, place).otherwise(len(priority) + 1), "number")
    return rows.select("station", "number").distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def station_kind(df: DataFrame, value: str = "value", date: str = "date", durations: str | None = None, coverage: float = 0.15, months: int = 2) -> DataFrame:
    """``pillow`` or ``snow_course`` by the listed durations, else by coverage, then by months with values, else ``unknown``."""
    has = F.col(value).isNotNull()
    stats = df.groupBy("station").agg(
        F.avg(has.cast("double")).alias("coverage"), F.count_distinct(F.when(has, F.trunc(date, "month"))).alias("months"), (F.collect_set(F.lower(durations)) if durations else F.array()).alias("d")
    )
    listed = F.when(F.exists("d", lambda x: x.rlike("daily|hourly|event")), "pillow").when(F.exists("d", lambda x: x.rlike("month")), "snow_course")
    seen = F.when(F.col("coverage") >= coverage, "pillow").when(F.col("months") >= months, "snow_course").otherwise("unknown")
    return stats.select("station", "coverage", "months", F.coalesce(listed, seen).alias("kind"))


def normalize_headers(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns renamed by the first pattern that their header matches (C6); each new name is used once."""
    used: set[str] = set()
    out = {}
    for c in df.columns:
        new = next((n for p, n in names.items() if n not in used and re.search(p, c, re.I)), None)
        if new:
            used.add(new)
            out[c] = new
    return df.withColumnsRenamed(out)


def html_location(html: Column) -> Column:
    """Struct (lat, lon, elev_ft) of a station page's text.

    Latitude and longitude come as a pair, the longitude after the latitude, or are both null; the elevation is a number
    of feet, with or without separators of thousands.
    """
    signed = r"([-+]?\d+(?:\.\d+)?)"
    pair = rf"(?is)latitude\s*{signed}\D+longitude\s*{signed}"
    part = lambda i: F.regexp_extract(html, pair, i).try_cast("double")
    feet = F.regexp_extract(html, r"(?i)elevation\s*(\d[\d,]*(?:\.\d+)?)\s*ft", 1)
    return F.struct(part(1).alias("lat"), part(2).alias("lon"), F.replace(feet, F.lit(","), F.lit("")).try_cast("double").alias("elev_ft"))


def html_facts(html: Column) -> Column:
    """Struct (title, n_links) of a page: the same extraction for pages without coordinates."""
    return F.struct(F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1).alias("title"), F.regexp_count(html, F.lit(r"(?i)<a\s")).cast("long").alias("n_links"))


def course_cadence(sensors: DataFrame, numbers: Sequence[int] = (18, 3, 82)) -> DataFrame:
    """For each station, whether all its snow sensors report monthly."""
    return sensors.where(F.col("number").isin(*numbers)).groupBy("station").agg(F.bool_and(F.lower("duration") == "monthly").alias("monthly"))
