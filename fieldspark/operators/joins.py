"""Joins of surveys, stations, grids and products: nearest dates, thresholds, corrections, masks, polygons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.units import clip_negative
from fieldspark.sources.tables import small_side, written


def survey_with_stations(labels: DataFrame, obs: DataFrame, band: str = "total") -> DataFrame:
    """Survey dates with each station's value of the same day, for one band."""
    survey = labels.where(F.col("band") == band).select("basin", "date", F.col("value").alias("survey"))
    return survey.join(obs.select("basin", "date", "station", "value"), ["basin", "date"])


def wide_table(obs: DataFrame, stations: Sequence, base_station=None, outer: bool = True, value: str = "value") -> DataFrame:
    """One row a date with a column for each station.

    ``outer`` keeps all dates; else the dates of ``base_station`` (the first of a left-join chain).
    """
    wide = obs.groupBy("date").pivot("station", list(stations)).agg(F.first(value, ignorenulls=True))
    if outer:
        return wide
    dates = obs.where(F.col("station") == (stations[0] if base_station is None else base_station)).select("date").distinct()
    return dates.join(wide, "date", "left")


def nearest(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str = "value", tie: str = "later", within: int = 32) -> DataFrame:
    """Each left (keys, date) with the right row nearest in time: adds near_date and ``value``.

    ``tie`` says which of two equally near dates wins. Buckets of ``within`` days meet their neighbours first; the
    rows that find nothing within ``within`` days look back and ahead over the whole series, by one sort a series.
    """
    sign = -1 if tie == "later" else 1
    l = left.select(*keys, "date").distinct().withColumn("__b", F.floor(F.unix_date("date") / within))  # noqa: E741
    r = right.where(F.col(value).isNotNull()).select(*keys, F.col("date").alias("near_date"), value)
    near = l.withColumn("__b", F.explode(F.array(F.col("__b") - 1, "__b", F.col("__b") + 1)))
    hit = near.join(r.withColumn("__b", F.floor(F.unix_date("near_date") / within)), [*keys, "__b"])
    gap = F.date_diff("near_date", "date")
    hit = hit.where(F.abs(gap) <= within)
    best = hit.groupBy(*keys, "date").agg(F.min_by(F.struct("near_date", value), F.struct(F.abs(gap), sign * gap)).alias("m"))
    rest = l.drop("__b").join(best, [*keys, "date"], "left_anti")
    r = r.join(rest.select(*keys).distinct(), list(keys), "left_semi")  # only series that have such rows
    both = rest.select(*keys, "date", F.lit(None).cast("date").alias("near_date"), F.lit(None).cast(dict(right.dtypes)[value]).alias(value), F.lit(1).alias("__q"))
    both = both.unionByName(r.select(*keys, F.col("near_date").alias("date"), "near_date", value, F.lit(0).alias("__q")))
    w = Window.partitionBy(*keys).orderBy("date", "__q")
    point = F.when(F.col("__q") == 0, F.struct("near_date", value))
    a = F.last(point, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    b = F.first(point, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    far = both.withColumns({"__x": a, "__y": b}).where("__q = 1")
    da, db = F.date_diff("date", "__x.near_date"), F.date_diff("__y.near_date", "date")
    before = db.isNull() | ((da < db) if tie == "later" else (da <= db))
    far = far.select(*keys, "date", F.when(F.coalesce(before, F.lit(False)), F.col("__x")).otherwise(F.coalesce("__y", "__x")).alias("m"))
    return best.unionByName(far).select(*keys, "date", "m.near_date", f"m.{value}")


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str = "value", direction: str = "backward") -> DataFrame:
    """Each left (keys, date) with the last right value up to it, or the first from it on."""
    l = left.select(*keys, "date", F.lit(None).cast("date").alias("near_date"), F.lit(None).cast(dict(right.dtypes)[value]).alias(value), F.lit(1).alias("__q")).distinct()  # noqa: E741
    r = right.where(F.col(value).isNotNull()).select(*keys, "date", F.col("date").alias("near_date"), value, F.lit(0).alias("__q"))
    point = F.when(F.col("__q") == 0, F.struct("near_date", value))
    if direction == "backward":
        m = F.last(point, ignorenulls=True).over(Window.partitionBy(*keys).orderBy("date", "__q").rowsBetween(Window.unboundedPreceding, 0))
    else:
        m = F.first(point, ignorenulls=True).over(Window.partitionBy(*keys).orderBy("date", F.desc("__q")).rowsBetween(0, Window.unboundedFollowing))
    return l.unionByName(r).withColumn("m", m).where("__q = 1").select(*keys, "date", "m.near_date", f"m.{value}")


def season_part(df: DataFrame, thresholds: DataFrame, part: str, keys: Sequence[str] = ("year", "elev_bin")) -> DataFrame:
    """Rows before (``accum``) or from (``melt``) their key's threshold date on; without a threshold they go.

    The table is a small dimension; repeated keys count once. The year is the calendar year.
    """
    t = small_side(written(thresholds.dropDuplicates(list(keys)).select(*keys, "threshold"), "thresholds"))
    joined = df.join(t, list(keys))
    return joined.where(F.col("date") < F.col("threshold") if part == "accum" else F.col("date") >= F.col("threshold"))


def correct(summary: DataFrame, qa: DataFrame, keys: Sequence[str] = ("basin", "station", "date"), value: str = "value") -> DataFrame:
    """Summary values replaced where the QA series differs (null equals null); rows it lacks stay; adds ``changed``."""
    q = qa.select(*keys, F.col(value).alias("__qa"), F.lit(True).alias("__has"))
    joined = summary.join(q, list(keys), "left")
    differs = F.coalesce(F.col("__has"), F.lit(False)) & ~F.col(value).eqNullSafe(F.col("__qa"))
    return joined.withColumn("changed", differs).withColumn(value, F.when(F.col("changed"), F.col("__qa")).otherwise(F.col(value))).drop("__qa", "__has")


def overwrite(obs: DataFrame, imputed: DataFrame, keys: Sequence[str] = ("basin", "station", "date"), value: str = "value") -> DataFrame:
    """Observations with imputed values in their place where there are any."""
    return obs.join(imputed.select(*keys, F.col(value).alias("__i")), list(keys), "left").withColumn(value, F.coalesce("__i", value)).drop("__i")


def align_products(products: DataFrame, names: Sequence[str], series: str = "name") -> DataFrame:
    """One row a date with a column for each product: a full outer alignment."""
    return products.groupBy("date").pivot(series, list(names)).agg(F.first("value", ignorenulls=True))


def in_mask(grid: DataFrame, mask: DataFrame, keys: Sequence[str] = ("y", "x"), clip: bool = True, value: str = "value") -> DataFrame:
    """Grid cells that the mask has, negative values clipped."""
    out = grid.join(mask.select(*keys).distinct(), list(keys), "left_semi")
    return out.withColumn(value, clip_negative(F.col(value))) if clip else out


def grid_at_stations(grid: DataFrame, cells: DataFrame, ranks: Sequence[str] = ("best", "second", "third"), value: str = "value") -> DataFrame:
    """Grid values of each station's ranked cells, one column a rank; a missing rank is null.

    The small cell table prunes the grid before anything is aggregated.
    """
    picked = grid.join(small_side(written(cells.where("y IS NOT NULL AND x IS NOT NULL"), "station-cells")), ["y", "x"])
    return picked.groupBy("station", "date").pivot("rank", list(ranks)).agg(F.first(value, ignorenulls=True))


def in_polygon(points: DataFrame, polygon: Sequence[tuple[float, float]], lon: str = "lon", lat: str = "lat", margin: float = 0.0) -> DataFrame:
    """Points inside a polygon: its bounding box prunes the scan, ray casting decides.

    A ring of a few thousand corners at most is an expression; ``margin`` widens the box and skips the ring test.
    """
    xs, ys = zip(*polygon, strict=True)
    box = F.col(lon).between(min(xs) - margin, max(xs) + margin) & F.col(lat).between(min(ys) - margin, max(ys) + margin)
    if margin:
        return points.where(box)
    edges = F.array(*[F.struct(*[F.lit(float(v)).alias(n) for v, n in zip((*a, *b), ("x1", "y1", "x2", "y2"), strict=True)]) for a, b in zip(polygon, [*polygon[1:], polygon[0]], strict=True)])

    def crosses(e: Column) -> Column:
        spans = (e["y1"] > F.col(lat)) != (e["y2"] > F.col(lat))
        at = (e["x2"] - e["x1"]) * (F.col(lat) - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
        return spans & (F.col(lon) < at)

    return points.where(box & (F.size(F.filter(edges, crosses)) % 2 == 1))


def polygon_edges(corners: DataFrame, area: str = "area") -> DataFrame:
    """(area, x1, y1, x2, y2) of closed rings given as (area, ring, seq, x, y): each corner and the next, the last and the first."""
    ring = Window.partitionBy(area, "ring")
    nxt = lambda c: F.coalesce(F.lead(c).over(ring.orderBy("seq")), F.first(c).over(ring.orderBy("seq")))
    ends = corners.select(area, F.col("x").cast("double").alias("x1"), F.col("y").cast("double").alias("y1"), nxt(F.struct("x", "y")).alias("b"))
    return ends.select(area, "x1", "y1", F.col("b.x").cast("double").alias("x2"), F.col("b.y").cast("double").alias("y2"))


def edge_index(edges: DataFrame, height: float, area: str = "area") -> DataFrame:
    """(row, area, lo, hi, edges): for each row of cells of ``height`` the edges of an area that cross it, and their extent in x."""
    top, low = F.greatest("y1", "y2"), F.least("y1", "y2")
    sloped = edges.where("y1 <> y2")  # a level edge crosses no ray
    rows = sloped.select(area, "x1", "y1", "x2", "y2", F.explode(F.sequence(F.floor(low / height), F.floor(top / height))).alias("row"))
    return rows.groupBy("row", area).agg(F.min(F.least("x1", "x2")).alias("lo"), F.max(F.greatest("x1", "x2")).alias("hi"), F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))


def areas_of_points(points: DataFrame, corners: DataFrame, height: float, area: str = "area", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``points`` with each area that holds them (J15), one row an area; points in no area are left out.

    ``corners`` is a table of polygons (area, ring, seq, x, y) of any number; several rings of an area count by parity,
    so inner rings are holes. Points meet only the edges that cross their own row of cells of ``height``. A ray to the
    right decides: a point on a left or lower edge is inside, on a right or upper edge outside, so areas that share an
    edge share no point.
    """
    index = written(edge_index(polygon_edges(corners, area), height, area), "polygon-rows")
    placed = points.withColumn("row", F.floor(F.col(lat) / height))
    near = placed.join(small_side(index), "row").where(F.col(lon).between(F.col("lo"), F.col("hi")))

    def crosses(e: Column) -> Column:
        spans = (e["y1"] > F.col(lat)) != (e["y2"] > F.col(lat))
        at = (e["x2"] - e["x1"]) * (F.col(lat) - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        return spans & (F.col(lon) < at)

    return near.where(F.size(F.filter("edges", crosses)) % 2 == 1).select(*points.columns, area)


def daily_status(raw: DataFrame, qa: DataFrame, excluded: DataFrame | None = None, best_case: bool = False, value: str = "value") -> DataFrame:
    """missing / excluded / failed / usable for each (basin, station, date) of ``raw``.

    A day is failed if QA took its value away; ``best_case`` counts failed days as usable.
    """
    keys = ["basin", "station", "date"]
    rows = raw.select(*keys, F.col(value).alias("raw")).join(qa.select(*keys, F.col(value).alias("qa")), keys, "left")
    if excluded is not None:
        rows = rows.join(excluded.select(*keys, F.lit(True).alias("ex")).distinct(), keys, "left")
    else:
        rows = rows.withColumn("ex", F.lit(None).cast("boolean"))
    status = F.when(F.col("raw").isNull(), "missing").when(F.col("ex"), "excluded").when(F.col("qa").isNull() & F.lit(not best_case), "failed").otherwise("usable")
    return rows.select(*keys, status.alias("status"))


def usable_sets(status: DataFrame) -> DataFrame:
    """The usable stations of each basin's day, in order of id."""
    return status.groupBy("basin", "date").agg(F.sort_array(F.collect_set(F.when(F.col("status") == "usable", F.col("station")))).alias("usable"))


def observed_and_predicted(obs: DataFrame, pred: DataFrame, keys: Sequence[str] = ("basin", "station", "date")) -> DataFrame:
    """Observations and predictions side by side."""
    return obs.select(*keys, F.col("value").alias("observed")).join(pred.select(*keys, F.col("value").alias("predicted")), list(keys), "left")
