"""Aggregates of grids, products and predictions: zones, baselines, metrics, windows, selections, reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.units import CELL_M2, acre_feet, convert
from fieldspark.sources.tables import small_side, written


def band_means(grid: DataFrame, cell_band: DataFrame, cell_m2: float = CELL_M2) -> DataFrame:
    """Mean depth of a band's non-null cells, area of all its cells and volume (A4): (date, band, mean_m, area_m2, acre_ft).

    Depths are joined to the mask once; the area of a band doesn't depend on the date and is counted apart.
    """
    areas = cell_band.groupBy("band").agg((F.count("*") * F.lit(cell_m2)).alias("area_m2"))
    means = grid.where("value IS NOT NULL").join(cell_band, ["y", "x"]).groupBy("date", "band").agg(F.avg("value").alias("mean_m"))
    return means.join(small_side(written(areas, "band-areas")), "band").select("date", "band", "mean_m", "area_m2", acre_feet(F.col("mean_m"), F.col("area_m2")).alias("acre_ft"))


def band_acres(cell_band: DataFrame, mask: DataFrame | None = None, cell_m2: float = CELL_M2) -> DataFrame:
    """Area of each band in acres, within the mask's cells if one is given (A5)."""
    cells = cell_band if mask is None else cell_band.join(mask.select("y", "x").distinct(), ["y", "x"], "left_semi")
    return cells.groupBy("band").agg(convert(F.count("*") * F.lit(cell_m2), "m2", "acre").alias("acres"))


def survey_volumes(grid: DataFrame, cell_band: DataFrame, acres: DataFrame) -> DataFrame:
    """Mean of each survey's band in feet times the band's acres."""
    means = grid.where("value IS NOT NULL").join(cell_band, ["y", "x"]).groupBy("date", "band").agg(F.avg("value").alias("mean_m"))
    return means.join(small_side(written(acres, "band-acres")), "band").select("date", "band", (convert(F.col("mean_m"), "m", "ft") * F.col("acres")).alias("acre_ft"))


def band_counts(cells: DataFrame, bands: DataFrame, value: str = "elev") -> DataFrame:
    """Cells in each band, zero where there are none, in band order."""
    hit = cells.join(F.broadcast(bands), (F.col(value) >= F.col("lo")) & (F.col(value) < F.col("hi"))).groupBy("band").agg(F.count("*").alias("n"))
    return bands.join(hit, "band", "left").select("ord", "band", F.coalesce("n", F.lit(0)).alias("n")).orderBy("ord")


def baseline(table: DataFrame, value: str = "value") -> DataFrame:
    """Baseline cells (basin, station, date, value) without gaps.

    Stations whose calendar-year sums are all non-zero stay; then the dates on which all of these have values; then
    the stations that have one on each of these dates. A station that reads zero all year goes, as in the original.
    """
    years = table.groupBy("basin", "station", F.year("date").alias("yr")).agg(F.sum(value).alias("s"))
    all_years = table.select("basin", F.year("date").alias("yr")).distinct().groupBy("basin").agg(F.count("*").alias("n_years"))
    good = years.groupBy("basin", "station").agg(F.count_if(F.coalesce(F.col("s") != 0, F.lit(False))).alias("ok")).join(all_years, "basin").where("ok = n_years").select("basin", "station")
    n = good.groupBy("basin").agg(F.count("*").alias("n"))
    known = table.where(F.col(value).isNotNull()).join(good, ["basin", "station"], "left_semi")
    dates = known.groupBy("basin", "date").agg(F.count_distinct("station").alias("m")).join(n, "basin").where("m = n").select("basin", "date")
    return known.join(dates, ["basin", "date"], "left_semi").select("basin", "station", "date", value)


def exact_medians(df: DataFrame, by: Sequence[str], x: str, alias: str = "median", bins: int = 4096, few: int = 100_000) -> DataFrame:
    """(by, alias): the exact median of each group, equal to ``F.median``, in memory that doesn't grow with the groups.

    Histograms of counts, refined: each pass counts the rows of ``bins`` equal parts of the span that holds the wanted
    rank and keeps the part where it lies; after two or three passes a part holds one value, or few rows, which are
    then ranked. Nulls are left out, groups without values too; nan is greater than all, as in Spark's order.
    """
    keys = [f"__k{i}" for i in range(len(by))]
    key = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(by, keys, strict=True)] or [F.lit(True)]
    rows = df.where(F.col(x).isNotNull()).select(*by, F.col(x).cast("double").alias("__x"))
    rows = written(rows.select(*by, F.when(~F.isnan("__x"), F.col("__x")).alias("__x"), F.isnan("__x").alias("__nan")), "median-rows")
    ends = rows.groupBy(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)]).agg(F.min("__x").alias("lo"), F.max("__x").alias("hi"), F.count("__x").alias("n"), F.count("*").alias("all")).where(F.col("all") > 0)
    ranks = F.explode(F.array_distinct(F.array(F.floor((F.col("all") + 1) / 2), F.floor(F.col("all") / 2) + 1))).alias("rank")
    state = written(ends.select(*keys, "lo", "hi", "n", "all", ranks).withColumns({"below": F.lit(0).cast("long"), "inside": F.col("n")}), "median-state")
    own = [*keys, "rank"]
    while True:
        open_ = state.where((F.col("rank") <= F.col("n")) & (F.col("lo") < F.col("hi")))
        many = open_.where(F.col("inside") > few)
        if many.isEmpty():
            break
        met = rows.join(small_side(many), reduce(lambda a, b: a & b, key)).where(F.col("__x").between(F.col("lo"), F.col("hi")))
        place = F.least(F.floor((F.col("__x") / bins - F.col("lo") / bins) / (F.col("hi") / bins - F.col("lo") / bins) * bins), F.lit(bins - 1))
        counts = met.groupBy(*own, "n", "all", "below", place.alias("bin")).agg(F.count("*").alias("inside"), F.min("__x").alias("lo"), F.max("__x").alias("hi"))
        upto = F.sum("inside").over(Window.partitionBy(*own).orderBy("bin"))  # at most ``bins`` rows
        part = counts.withColumn("upto", upto).where(F.col("rank").between(F.col("below") + F.col("upto") - F.col("inside") + 1, F.col("below") + F.col("upto")))
        part = part.withColumn("below", F.col("below") + F.col("upto") - F.col("inside"))
        settled = state.join(many.select(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(own)]), reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__o{i}")) for i, c in enumerate(own)]), "left_anti")
        state = written(settled.unionByName(part.select(*state.columns)), "median-state")
    met = rows.join(small_side(open_), reduce(lambda a, b: a & b, key)).where(F.col("__x").between(F.col("lo"), F.col("hi")))
    nth = met.withColumn("__i", F.row_number().over(Window.partitionBy(*own).orderBy("__x"))).where(F.col("__i") == F.col("rank") - F.col("below"))
    alone = state.where((F.col("rank") > F.col("n")) | (F.col("lo") >= F.col("hi")))
    value = F.when(F.col("rank") > F.col("n"), F.lit(float("nan"))).otherwise(F.col("lo"))
    found = nth.select(*keys, "rank", F.col("__x").alias("v")).unionByName(alone.select(*keys, "rank", value.alias("v")))
    middle = 0.5 * F.min_by("v", "rank") + 0.5 * F.max_by("v", "rank")
    return found.groupBy(*keys).agg(middle.alias(alias)).select(*[F.col(k).alias(c) for c, k in zip(by, keys, strict=True)], alias)


def metrics(df: DataFrame, by: Sequence[str], y: str, p: str, mask: float = 50.0, large: bool = False) -> DataFrame:
    """Regression metrics of each group (A17, A18); log errors take values above -1, percentages y of at least ``mask``.

    ``large``: the medians come from refined histograms (``exact_medians``), so that no group's values are held at once.
    """
    a, b = F.col(y), F.col(p)
    e = a - b
    big = a >= mask
    rows = df.where(a.isNotNull() & b.isNotNull())
    middle = F.lit(None).cast("double") if large else F.median(F.abs(e))
    out = rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.when(F.var_pop(a) > 0, 1 - F.var_pop(e) / F.var_pop(a)).alias("explained_variance"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.when((a > -1) & (b > -1), F.pow(F.log1p(a) - F.log1p(b), F.lit(2)))).alias("msle"),
        middle.alias("median_ae"),
        F.pow(F.corr(a, b), F.lit(2)).alias("r2"),
        F.max(F.when(big, F.abs(e))).alias("max_abs"),
        F.max(F.when(big, F.abs(e) / a * 100)).alias("max_pct"),
    )
    if not large:
        return out
    medians = exact_medians(rows.select(*by, F.abs(e).alias("__e")), by, "__e", "__m").select(*[F.col(c).alias(f"__b{i}") for i, c in enumerate(by)], "__m")
    same = reduce(lambda p, q: p & q, [F.col(c).eqNullSafe(F.col(f"__b{i}")) for i, c in enumerate(by)], F.lit(True))
    return out.join(medians, same, "left").withColumn("median_ae", F.col("__m")).select(*out.columns)


def product_kpi(products: DataFrame, survey: DataFrame, total: str = "total") -> DataFrame:
    """Each product's absolute error of the total in percent and RMSE over bands (A19); products without the date go."""
    joined = products.join(survey.select("date", "band", F.col("value").alias("truth")), ["date", "band"])
    d = F.col("value") - F.col("truth")
    part = F.col("band") == total
    return joined.groupBy("name", "date").agg(
        F.max(F.when(part, F.abs(d) / F.col("truth") * 100)).alias("total_error_pct"), F.sqrt(F.avg(F.when(~part, d * d))).alias("rmse_bands")
    )


def bias(df: DataFrame, survey: str, model: str) -> DataFrame:
    """Difference model - survey and ratio survey / model of each date."""
    return df.select("date", survey, model, (F.col(model) - F.col(survey)).alias("diff"), (F.col(survey) / F.nullif(F.col(model), F.lit(0.0))).alias("ratio"))


def bias_factor(df: DataFrame) -> DataFrame:
    """The median of the ratios, by which a model's totals are multiplied (A20); the ratios never meet in one buffer."""
    known = df.agg(F.avg("ratio").alias("mean_ratio"), F.count("ratio").alias("n"))
    return known.join(F.broadcast(exact_medians(df, [], "ratio", "factor")), how="left").select("factor", "mean_ratio", "n")  # one row each


def common_window(df: DataFrame, series: str = "series", value: str = "value") -> DataFrame:
    """(start, end): the dates that all series cover; series without values are left out."""
    spans = df.where(F.col(value).isNotNull()).groupBy(series).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return spans.agg(F.max("a").alias("start"), F.min("b").alias("end"))


def in_common_window(df: DataFrame, series: str = "series", value: str = "value") -> DataFrame:
    window = F.broadcast(common_window(df, series, value))  # one row
    return df.join(window, F.col("date").between(F.col("start"), F.col("end"))).drop("start", "end")


def date_checks(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct dates, repeated dates and latest date of each series."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count_distinct("date").alias("n_dates"), F.max("date").alias("latest")).withColumn("repeated", F.col("n_rows") > F.col("n_dates"))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Counts in ``bins`` equal widths between the least and the greatest value, which falls in the last (A24): (bin, n)."""
    known = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    ends = F.broadcast(known.agg(F.min("v").alias("lo"), F.max("v").alias("hi")))  # one row
    place = F.floor((F.col("v") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * bins)
    return known.crossJoin(ends).select(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))


def selection_rows(df: DataFrame, column: str, value: str = "station") -> DataFrame:
    """One row for each name of a comma list."""
    return df.select(*[c for c in df.columns if c != column], F.explode(F.split(F.trim(column), r"\s*,\s*")).alias(value)).where(F.col(value) != "")


def selection_matrix(df: DataFrame, column: str, dates: Sequence) -> DataFrame:
    """Stations by dates with 1 where the date's list has the station, else 0."""
    return selection_rows(df, column).groupBy("station").pivot("date", list(dates)).agg(F.lit(1)).na.fill(0)


def selection_presence(df: DataFrame, column: str) -> DataFrame:
    """(station, date, picked): 1 where the date's lists have the station, else 0, for every date and every station that any list has.

    The long form of the matrix, for any number of dates.
    """
    picked = selection_rows(df, column).select("station", "date").distinct()
    stations, dates = written(picked.select("station").distinct(), "presence-stations"), df.select("date").distinct()
    every = dates.join(small_side(stations))  # the result has this many rows
    return every.join(picked.withColumn("picked", F.lit(1)), ["station", "date"], "left").na.fill(0, ["picked"])


def selection_codes(df: DataFrame, codes: dict[str, int], season: str = "season", by: Sequence[str] = ("station", "date")) -> DataFrame:
    """Bits of the seasons that select a station on a date, joined by or."""
    bit = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])[F.col(season)]
    return df.groupBy(*by).agg(F.bit_or(bit).alias("code"))


def changed_cells(raw: DataFrame, clean: DataFrame, keys: Sequence[str] = ("basin", "station", "date"), value: str = "value") -> DataFrame:
    """Cells with whether cleaning changed them (two nulls are equal) and whether they have a value."""
    c = clean.select(*keys, F.col(value).alias("__c"))
    return raw.join(c, list(keys), "left").select(*keys, (~F.col(value).eqNullSafe(F.col("__c"))).alias("changed"), F.col("__c").isNotNull().alias("has_value"))


def climatology(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Rows with the median of their day of the year over all years."""
    day = F.dayofyear("date")
    normal = df.groupBy(*keys, day.alias("doy")).agg(F.median(value).alias("normal"))
    return df.withColumn("doy", day).join(normal, [*keys, "doy"], "left")


def row_summary(df: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Sum, median and mean over the stations or bands of each row key."""
    return df.groupBy(*by).agg(F.sum(value).alias("sum"), F.median(value).alias("median"), F.avg(value).alias("mean"), F.count(value).alias("n"))


def rmse_sheet(df: DataFrame, model: str, band: str, bands: Sequence[str], rmse: str = "rmse") -> DataFrame:
    """One row a model with a column for each band's RMSE."""
    return df.groupBy(model).pivot(band, list(bands)).agg(F.first(rmse))


def band_sheet(df: DataFrame, by: Sequence[str], bands: Sequence[str], value: str = "value", lists: bool = False) -> DataFrame:
    """One row a day with a column for each band: volumes, or station lists joined by commas."""
    cell: Column = F.array_join(F.transform(F.first(value), lambda x: x.cast("string")), ", ") if lists else F.first(value)
    return df.groupBy(*by).pivot("band", list(bands)).agg(cell)


def common_years(*sources: DataFrame) -> DataFrame:
    """Water years that all sources have."""
    out = sources[0].select("wy")
    for s in sources[1:]:
        out = out.intersect(s.select("wy"))
    return out.distinct().orderBy("wy")


def union_all(*parts: DataFrame) -> DataFrame:
    """All rows of tables whose columns may differ; what one lacks is null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def union_set(*parts: DataFrame) -> DataFrame:
    """Distinct rows of all parts, as of configured and chosen exclusions."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


#: What the columns of a prediction sheet mean.
SHEET_COLUMNS = (
    ("date", "day of the prediction"),
    ("model", "stations that fill gaps: peers or grid"),
    ("season", "part of the year that the model was trained on: season, accum or melt"),
    ("mode", "how gaps were handled in training: drop or impute"),
    ("band", "elevation band; total is the basin"),
    ("value", "volume in acre-feet, whole"),
    ("stations", "stations used, joined by commas"),
)


def sheet_description(sheet: DataFrame) -> DataFrame:
    """What each column of a long prediction sheet means, and how many values it has (M14): (column, meaning, n_values, n_distinct).

    Columns without a known meaning have a null one.
    """
    counts = [F.struct(F.lit(c).alias("column"), F.count(c).alias("n_values"), F.count_distinct(c).alias("n_distinct")) for c in sheet.columns]
    found = sheet.agg(F.array(*counts).alias("c")).select(F.inline("c"))
    meaning = F.create_map(*[F.lit(x) for pair in SHEET_COLUMNS for x in pair])[F.col("column")]
    return found.select("column", meaning.alias("meaning"), "n_values", "n_distinct")


def combine_networks(a: DataFrame, b: DataFrame, names_b: dict[str, str], feet_b: Sequence[str] = ()) -> DataFrame:
    """Station lists of two networks under one schema; names lower-cased, feet as metres."""
    b = b.withColumnsRenamed(names_b)
    b = b.withColumns({c: convert(F.col(c), "ft", "m") for c in feet_b})
    return union_all(a, b).withColumn("network", F.lower("network"))
