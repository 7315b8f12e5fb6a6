"""Units, water years, bands, labels and names: column functions and small joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Factors of unit conversions (fixed values).
FACTORS = {
    ("in", "mm"): 25.4,
    ("mm", "in"): 0.0393701,
    ("ft", "m"): 0.3048,
    ("m", "mm"): 1000.0,
    ("m", "ft"): 3.28084,
    ("m2", "acre"): 0.000247105,
    ("m3", "acreft"): 0.000810714,
    ("acreft", "taf"): 0.001,
}
CELL_M2 = 2500.0


def convert(value: Column, source: str, target: str) -> Column:
    """The value in the target unit."""
    return value if source == target else value * F.lit(FACTORS[source, target])


def acre_feet(depth_m: Column, area_m2: Column) -> Column:
    return depth_m * area_m2 * F.lit(FACTORS["m3", "acreft"])


def clip_negative(value: Column) -> Column:
    """Zero instead of negative values; null stays null."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def whole_taf(value: Column) -> Column:
    """Whole thousands: truncated to an integer first, then divided and truncated again."""
    return (value.cast("long") / 1000).cast("long")


def band_sum_taf(df: DataFrame, by: Sequence[str], band: str = "band", value: str = "value", total: str = "total") -> DataFrame:
    """Bands, their sum and the total in whole thousands; the sum adds whole acre-feet before it divides."""
    whole = F.col(value).cast("long")
    parts = df.groupBy(*by).agg(
        F.sum(F.when(F.col(band) != total, whole)).alias("s"), F.max(F.when(F.col(band) == total, whole)).alias("t")
    )
    return parts.select(*by, (F.col("s") / 1000).cast("long").alias("band_sum"), (F.col("t") / 1000).cast("long").alias("basin_total"))


def band_label(raw: Column) -> Column:
    """``7000-8000`` as ``7k-8k``, ``<7000`` as ``<7k``, any dash as ``-`` and ``Basin`` as ``total`` (U4)."""
    text = F.regexp_replace(F.trim(raw), "[\\u2012-\\u2015\\u2212]", "-")
    text = F.regexp_replace(F.regexp_replace(text, r"\s*-\s*", "-"), r"(\d+)000\b", "$1k")
    return F.when(F.lower(text).isin("basin", "total"), "total").otherwise(text)


def distinct_labels(df: DataFrame, label: str, order: Sequence[str]) -> DataFrame:
    """Repeated labels get `` (1)``, `` (2)`` … from their second row on."""
    n = F.row_number().over(Window.partitionBy(label).orderBy(*order)) - 1
    return df.withColumn("__n", n).withColumn(label, F.when(F.col("__n") > 0, F.concat(label, F.lit(" ("), "__n", F.lit(")"))).otherwise(F.col(label))).drop("__n")


def pick_modes(df: DataFrame, mode: str) -> DataFrame:
    """One row (drop_mode, predict_mode): the values that name dropping and predicting."""
    values = df.select(mode).where(F.col(mode).isNotNull()).distinct()
    low = F.lower(mode)
    return values.agg(F.min(F.when(low.contains("drop"), F.col(mode))).alias("drop_mode"), F.min(F.when(low.rlike("predict|impute"), F.col(mode))).alias("predict_mode"))


def water_year(date: Column) -> Column:
    """The year in which the water year from October on ends."""
    return F.year(date) + F.when(F.month(date) >= 10, 1).otherwise(0)


def water_day(date: Column) -> Column:
    """1 on the first of October."""
    return F.date_diff(date, F.make_date(water_year(date) - 1, F.lit(10), F.lit(1))) + 1


def season_angle(date: Column, period: float = 365.25) -> tuple[Column, Column]:
    """(sin, cos) of the water day's phase."""
    phase = 2 * F.pi() * water_day(date) / F.lit(period)
    return F.sin(phase), F.cos(phase)


def compact_date(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd")


def padded_date(year: Column, month: Column, day: Column) -> Column:
    """``YYYYMMDD`` of three numbers (U8)."""
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))


def with_band(df: DataFrame, value: str, bands: DataFrame) -> DataFrame:
    """``df`` with the band whose [lo, hi) holds the value: a range join with the small band table."""
    return df.join(F.broadcast(bands), (F.col(value) >= F.col("lo")) & (F.col(value) < F.col("hi")))


def index_box(df: DataFrame, y: tuple[int, int], x: tuple[int, int]) -> DataFrame:
    """Cells of an index box, both ends included."""
    return df.where(F.col("y").between(*y) & F.col("x").between(*x))


def pick_column(columns: Sequence[str], preferred: Sequence[str]) -> str:
    """The first preferred name that a table has, else its first that holds ``swe``."""
    for name in [*preferred, *(c for c in columns if "swe" in c.lower())]:
        if name in columns:
            return name
    raise ValueError(f"none of {list(preferred)} in {list(columns)}")


def abbreviations(df: DataFrame, name: str, order: str) -> DataFrame:
    """Unique short codes: three letters of the name, with the number of the collision from the second on."""
    code = F.upper(F.substring(F.regexp_replace(name, "[^A-Za-z]", ""), 1, 3))
    df = df.withColumn("__c", code)
    n = F.row_number().over(Window.partitionBy("__c").orderBy(order)) - 1
    return df.withColumn("code", F.concat("__c", F.when(n > 0, n.cast("string")).otherwise(""))).drop("__c")
