"""Queries of regression, imputation, selection and prediction. SQL expresses the one-predictor fits; numpy checks the rest in the tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.functions.units import CELL_M2, water_year
from fieldspark.operators import models as M
from fieldspark.operators import qa as Q
from fieldspark.operators.calendars import daily_calendar
from fieldspark.plans.catalog import query, with_views
from fieldspark.plans.series import FULL, STATIC, VOTING, full, history, ranking
from fieldspark.sources import views as V
from fieldspark.sources.tables import scratch, small_side, written

CELLS = ["g1", "g2", "g3"]
CELLS_SQL = "WITH c AS (SELECT n_regionkey AS basin, s_nationkey AS station, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS value, sum(l_extendedprice) / 1000 AS g1, sum(l_tax) * 100 AS g2, CAST(count(*) AS DOUBLE) AS g3 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)"


def with_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Station days with three grid-like predictors."""
    lines = V.table(spark, sf, "lineitem").join(V.table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = lines.join(V.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    keys = [F.col("n_regionkey").alias("basin"), F.col("s_nationkey").alias("station"), F.to_date("l_shipdate").alias("date")]
    return rows.groupBy(*keys).agg(F.sum("l_quantity").alias("value"), (F.sum("l_extendedprice") / 1000).alias("g1"), (F.sum("l_tax") * 100).alias("g2"), F.count("*").cast("double").alias("g3"))


@query("m1_ols_one_predictor", CELLS_SQL + " SELECT basin, station, count(*) AS n, round(regr_intercept(value, g1), 6) AS intercept, round(regr_slope(value, g1), 6) AS slope, round(sqrt(regr_syy(value, g1) * (1 - regr_r2(value, g1)) / (count(*) - 2)), 6) AS sigma FROM c GROUP BY ALL")
def _(spark, sf):
    fits = M.fit_ols(with_cells(spark, sf), M.KEYS, "value", ["g1"], 3)
    return fits.select("basin", "station", "n", F.round("intercept", 6).alias("intercept"), F.round(F.get("beta", F.lit(0)), 6).alias("slope"), F.round("sigma", 6).alias("sigma"))


def three_sql(rows: str, least: int) -> str:
    """CTEs s (moments), d (adjugate of the covariances) and f: the three-predictor fit of ``rows`` in closed form."""
    pairs = [("g1", "g1", "a11"), ("g1", "g2", "a12"), ("g1", "g3", "a13"), ("g2", "g2", "a22"), ("g2", "g3", "a23"), ("g3", "g3", "a33"), ("g1", "value", "b1"), ("g2", "value", "b2"), ("g3", "value", "b3"), ("value", "value", "yy")]
    moments = ", ".join(f"covar_pop({x}, {y}) AS {name}" for x, y, name in pairs)
    return (
        f", s AS (SELECT basin, station, count(*) AS n, avg(value) AS my, avg(g1) AS m1, avg(g2) AS m2, avg(g3) AS m3, {moments} FROM {rows} GROUP BY ALL HAVING count(*) >= {least})"
        ", d AS (SELECT *, a22 * a33 - a23 * a23 AS i11, a13 * a23 - a12 * a33 AS i12, a12 * a23 - a13 * a22 AS i13, a11 * a33 - a13 * a13 AS i22, a12 * a13 - a11 * a23 AS i23, a11 * a22 - a12 * a12 AS i33 FROM s)"
        ", e AS (SELECT *, a11 * i11 + a12 * i12 + a13 * i13 AS det FROM d)"
        ", p AS (SELECT *, (i11 * b1 + i12 * b2 + i13 * b3) / det AS p1, (i12 * b1 + i22 * b2 + i23 * b3) / det AS p2, (i13 * b1 + i23 * b2 + i33 * b3) / det AS p3 FROM e)"
        ", f AS (SELECT *, my - p1 * m1 - p2 * m2 - p3 * m3 AS p0, sqrt(greatest(n * (yy - p1 * b1 - p2 * b2 - p3 * b3), 0) / (n - 4)) AS sigma FROM p)"
    )


@query("m1_ols_three_predictors", CELLS_SQL + three_sql("c", 5) + " SELECT basin, station, n, round(p0, 4) AS intercept, round(p1, 4) AS b1, round(p2, 4) AS b2, round(p3, 4) AS b3, round(sigma, 4) AS sigma FROM f")
def _(spark, sf):
    fits = M.fit_ols(with_cells(spark, sf), M.KEYS, "value", CELLS, 5)
    beta = [F.round(F.get("beta", F.lit(i)), 4).alias(f"b{i + 1}") for i in range(3)]
    return fits.select("basin", "station", "n", F.round("intercept", 4).alias("intercept"), *beta, F.round("sigma", 4).alias("sigma"))


@query("m4_fitted", CELLS_SQL + ", f AS (SELECT basin, station, regr_intercept(value, g1) AS a, regr_slope(value, g1) AS b FROM c GROUP BY ALL) SELECT basin, station, date, round(a + b * g1, 6) AS yhat, round(value - a - b * g1, 6) AS resid FROM c JOIN f USING (basin, station)")
def _(spark, sf):
    out = M.fitted(with_cells(spark, sf), M.KEYS, "value", ["g1"])
    return out.select("basin", "station", "date", F.round("yhat", 6).alias("yhat"), F.round("resid", 6).alias("resid"))


@query(
    "m3_impute_from_grid",
    CELLS_SQL + ", g AS (SELECT basin, station, date, g1, CASE WHEN (station + day(date)) % 5 > 0 THEN value END AS value FROM c), f AS (SELECT basin, station, regr_intercept(value, g1) AS a, regr_slope(value, g1) AS b FROM g WHERE value IS NOT NULL AND date >= DATE '1996-01-01' GROUP BY ALL HAVING count(*) >= 20) SELECT basin, station, date, value IS NULL AND a IS NOT NULL AS imputed, round(coalesce(value, greatest(a + b * g1, 0)), 6) AS value FROM g LEFT JOIN f USING (basin, station)",
)
def _(spark, sf):
    rows = with_cells(spark, sf).withColumn("value", F.when((F.col("station") + F.day("date")) % 5 > 0, F.col("value")))
    out = M.impute_from_grid(rows, rows, ["g1"], since="1996-01-01")
    return out.select("basin", "station", "date", "imputed", F.round("value", 6).alias("value"))


@query(
    "m13_training_report",
    CELLS_SQL + ", tr AS (SELECT * FROM c WHERE date < DATE '2000-10-01'), f AS (SELECT basin, station, regr_intercept(value, g1) AS a, regr_slope(value, g1) AS b FROM tr GROUP BY ALL) SELECT basin, station, date, 'train' AS model, round(a + b * g1, 6) AS yhat, round(value - a - b * g1, 6) AS resid FROM tr JOIN f USING (basin, station) UNION ALL SELECT basin, station, date, 'test', round(a + b * g1, 6), NULL FROM c JOIN f USING (basin, station) WHERE date >= DATE '2000-10-01'",
)
def _(spark, sf):
    rows = with_cells(spark, sf)
    out = M.training_report(rows.where("date < '2000-10-01'"), M.KEYS, "value", ["g1"], rows.where("date >= '2000-10-01'"))
    return out.select("basin", "station", "date", "model", F.round("yhat", 6).alias("yhat"), F.round("resid", 6).alias("resid"))


@query("m10_model_specs", " SELECT DISTINCT basin, band, mode, stack, season FROM labels, (VALUES ('drop'), ('impute')) a(mode), (VALUES ('peers'), ('grid')) b(stack), (VALUES ('season'), ('accum'), ('melt')) c(season)", ("labels",))
def _(spark, sf):
    return M.model_specs(V.labels(spark, sf))


@query(
    "m11_station_sets",
    ", s AS (SELECT basin, date, list_sort(list(DISTINCT station)) AS usable, coalesce(list_sort(list(DISTINCT station) FILTER (WHERE station % 5 < 3)), []) AS baseline FROM obs WHERE value > 30 GROUP BY ALL) SELECT basin, usable, baseline, count(*) AS n_days FROM s GROUP BY ALL",
    ("obs",),
)
def _(spark, sf):
    sets, _ = M.station_sets(*usable_days(spark, sf))
    return sets.select("basin", "usable", "baseline", "n_days")


def usable_days(spark, sf):
    """Stations of each day by a bound on their value, and the stations of the baseline."""
    obs = V.obs(spark, sf)
    return obs.where("value > 30"), obs.where("station % 5 < 3").select("basin", "station").distinct()


@query("m11_sets_served")
def _(spark, sf):
    """One training for each distinct station set; every day of every basin is predicted with its own set's model, in both modes.

    Mode ``impute`` uses the day's usable stations, ``drop`` those of them that are in the baseline. A day whose set is
    empty has a null prediction.
    """
    table = survey(spark, sf)[0]
    usable, baseline = usable_days(spark, sf)
    known = table.select("basin", F.explode("stations").alias("station")).distinct()
    sets, days = M.station_sets(usable.join(known, ["basin", "station"], "left_semi"), baseline)
    sets = written(sets.select("basin", "set_key", F.explode(F.create_map(F.lit("impute"), "usable", F.lit("drop"), "baseline")).alias("mode", "set")), "served-sets")
    fits = M.stored_models(table.select("basin", "band", "date", "y", "x"), M.set_asks(table, sets), scratch(spark, "served-models"))
    asked = sets.select("basin", "set_key", "mode", M.set_text(F.col("set")).alias("ask"))
    modes = F.explode(F.array(F.lit("impute"), F.lit("drop"))).alias("mode")
    tests = wide_days(table, full(spark, sf)).join(days, ["basin", "date"], "left").select("*", modes).join(small_side(asked), ["basin", "set_key", "mode"], "left")
    tests = tests.join(small_side(table.select("basin", "band").distinct()), "basin")
    pred = M.served(tests.select("basin", "band", "mode", "ask", "date", "x"), fits, ("basin", "band", "ask"), ("mode", "features", "score", "r2", "rmse"))
    return pred


@query("m2_impute_from_peers")
def _(spark, sf):
    days = written(full(spark, sf), "impute-rows")
    return M.impute_from_peers(days, days, since="1996-01-01").select("basin", "station", "date", "imputed", "value")


def survey(spark, sf):
    """The surveys of every basin's bands against gap-free stations: monthly means, so that all stations have a value."""
    monthly = V.obs(spark, sf).groupBy("basin", "station", F.trunc("date", "month").alias("date")).agg(F.avg("value").alias("value"))
    monthly = written(monthly, "survey-months")
    return written(M.survey_table(written(V.labels(spark, sf), "survey-labels"), monthly), "survey-table"), monthly


@query("m5_m7_loyo_selection")
def _(spark, sf):
    return M.loyo_select(survey(spark, sf)[0])


@query("a29_fold_stations")
def _(spark, sf):
    return M.fold_stations(M.loyo_select(survey(spark, sf)[0]))


@query("m8_m9_best_subset")
def _(spark, sf):
    table, _ = survey(spark, sf)
    cv = M.loyo_select(table)
    a = M.best_subset(table, cv).withColumn("rule", F.lit("subsets"))
    return a.unionByName(M.frequent_subset(table, cv).withColumn("rule", F.lit("frequency")))


def wide_days(table, values):
    """Every date of ``values`` (basin, date, stations, x) with the values of the table's stations in their order."""
    ids = table.groupBy("basin").agg(F.first("stations").alias("stations"))
    days = values.groupBy("basin", "date").agg(F.map_from_entries(F.collect_list(F.struct("station", "value"))).alias("m")).join(small_side(ids), "basin")
    return days.select("basin", "date", "stations", F.transform("stations", lambda s: F.try_element_at("m", s)).alias("x"))


def areas(spark, sf):
    """Area of each band: its number of survey customers as cells (the example has no other)."""
    return V.labels(spark, sf).groupBy("basin", "band").agg((F.count("*") * F.lit(CELL_M2)).alias("area_m2"))


@query("m12_m15_predict_days")
def _(spark, sf):
    """Back-test: every day of each water year that has earlier surveys is predicted by what was trained on these, in three units.

    Surveys of one calendar year can't be held out against others; days that have only these before them get nulls.
    """
    table = survey(spark, sf)[0]
    by = ("basin", "band")
    days = wide_days(table, full(spark, sf)).withColumn("ask", water_year(F.col("date")).cast("string"))
    asks = written(M.year_asks(table, days.select(F.col("ask").cast("int").alias("wy")).distinct()), "test-years")
    surveys = table.select(*by, "date", "y", "x")
    chosen = written(M.train(surveys, by, asks=asks), "test-models")
    fits = M.fit_chosen(surveys, chosen, by)
    tests = days.select("basin", "ask", "date", "x").join(small_side(asks.select(*by, "ask")), ["basin", "ask"])
    pred = M.served(tests, fits, (*by, "ask"), ("features", "score", "r2", "rmse"))
    return M.in_units(pred, areas(spark, sf)).withColumn("test_wy", F.col("ask").cast("int")).drop("ask")


#: Surveys (s) against the first station that has a monthly mean on every survey date of its basin.
ONE_STATION = (
    ", m AS (SELECT basin, station, CAST(date_trunc('month', date) AS DATE) AS date, avg(value) AS value FROM obs GROUP BY ALL), d AS (SELECT DISTINCT basin, date FROM labels), nd AS (SELECT basin, count(*) AS n FROM d GROUP BY 1)"
    ", fs AS (SELECT basin, min(station) AS station FROM (SELECT m.basin, m.station, count(DISTINCT m.date) AS n FROM m JOIN d USING (basin, date) GROUP BY ALL) JOIN nd USING (basin, n) GROUP BY 1)"
    ", s AS (SELECT l.basin, l.band, l.date, l.value AS y, m.value AS x, year(l.date) + CAST(month(l.date) >= 10 AS INT) AS wy FROM labels l JOIN fs USING (basin) JOIN m ON m.basin = l.basin AND m.station = fs.station AND m.date = l.date)"
)


def first_station(asks):
    """``asks`` restricted to the first station."""
    return asks.withColumn("use", F.array(F.lit(0)))


@query(
    "m5_m9_one_station",
    ONE_STATION
    + ", k AS (SELECT DISTINCT basin, band, year(date) AS fold FROM s), f AS (SELECT s.basin, s.band, k.fold, regr_intercept(s.y, s.x) AS a, regr_slope(s.y, s.x) AS b FROM s JOIN k ON k.basin = s.basin AND k.band = s.band AND k.fold <> year(s.date) GROUP BY ALL)"
    ", p AS (SELECT s.basin, s.band, s.y, greatest(a + b * x, 0) AS p FROM s JOIN f ON f.basin = s.basin AND f.band = s.band AND f.fold = year(s.date)), v AS (SELECT basin, band, count(*) AS n, coalesce(pow(corr(p, y), 2), 0) AS r2, sqrt(avg((p - y) * (p - y))) AS rmse FROM p GROUP BY ALL)"
    ", o AS (SELECT i.basin, i.band, i.date, i.y, greatest(regr_intercept(j.y, j.x) + regr_slope(j.y, j.x) * i.x, 0) AS p FROM s i JOIN s j ON j.basin = i.basin AND j.band = i.band AND j.date <> i.date GROUP BY i.basin, i.band, i.date, i.y, i.x)"
    ", w AS (SELECT basin, band, 1 - (1 - pow(corr(p, y), 2)) * (count(*) - 1) / (count(*) - 2) AS score FROM o GROUP BY ALL)"
    " SELECT basin, band, [0::INT] AS features, round(score, 7) AS score, n, round(r2, 7) AS r2, round(rmse, 2) AS rmse FROM v JOIN w USING (basin, band)",
    ("obs", "labels"),
)
def _(spark, sf):
    """The whole training with one station to choose from: held-out years, leave-one-out score and validation have closed forms."""
    table = survey(spark, sf)[0].select("basin", "band", "date", "y", "x")
    out = M.train(table, asks=first_station(M.one_ask(table, ("basin", "band"))))
    return out.select("basin", "band", "features", F.round("score", 7).alias("score"), "n", F.round("r2", 7).alias("r2"), F.round("rmse", 2).alias("rmse"))


@query(
    "m12_m15_one_station",
    ONE_STATION
    + ", t AS (SELECT date, year(date) + CAST(month(date) >= 10 AS INT) AS wy FROM days), r AS (SELECT s.basin, s.band, y.wy, s.y, s.x, year(s.date) AS cy FROM s JOIN (SELECT DISTINCT wy FROM t) y ON s.wy < y.wy)"
    ", g AS (SELECT basin, band, wy, regr_intercept(y, x) AS a, regr_slope(y, x) AS b, count(DISTINCT cy) AS years FROM (SELECT * FROM r UNION ALL SELECT DISTINCT basin, band, wy, 0, 0, NULL::BIGINT FROM r) GROUP BY ALL)"
    " SELECT g.basin, g.band, g.wy AS test_wy, t.date, CASE WHEN g.years > 1 AND o.value IS NOT NULL THEN round(greatest(a + b * o.value, 0), 4) END AS pred FROM g JOIN t USING (wy) JOIN fs USING (basin) LEFT JOIN obs o ON o.basin = g.basin AND o.station = fs.station AND o.date = t.date",
    ("obs", "labels", "days"),
)
def _(spark, sf):
    """The back-test of every day with one station to choose from: each year's fit is a regression on earlier surveys and the zero row."""
    table, by = survey(spark, sf)[0], ("basin", "band")
    days = written(wide_days(table, full(spark, sf)).select("basin", water_year(F.col("date")).cast("string").alias("ask"), "date", "x"), "test-days")
    asks = written(first_station(M.year_asks(table, days.select(F.col("ask").cast("int").alias("wy")).distinct())), "test-years")
    surveys = table.select(*by, "date", "y", "x")
    fits = M.fit_chosen(surveys, written(M.train(surveys, by, asks=asks), "test-models"), by)
    pred = M.served(days.join(small_side(asks.select(*by, "ask")), ["basin", "ask"]), fits, (*by, "ask"))
    return pred.select(*by, F.col("ask").cast("int").alias("test_wy"), "date", F.round("pred", 4).alias("pred"))


def spec_table(spark, sf):
    """(training rows, days to predict) of every mode, stack and season."""
    labels = written(V.labels(spark, sf), "spec-labels")  # read many times below, as are the others; the tables behind them once
    obs = written(daily_calendar(written(V.obs(spark, sf), "spec-obs")), "spec-days")
    cells = written(with_cells(spark, sf).groupBy("basin", "date").agg(F.avg("g1").alias("g1")), "spec-cells")
    gridded = written(obs.join(cells, ["basin", "date"], "left"), "spec-grid")
    filled = {("drop", "peers"): obs, ("drop", "grid"): obs, ("impute", "peers"): M.impute_from_peers(obs, obs, since="1996-01-01"), ("impute", "grid"): M.impute_from_grid(gridded, gridded, ["g1"], since="1996-01-01")}
    rows, days = [], []
    for (mode, stack), values in filled.items():
        values = written(values.select("basin", "station", "date", "value"), "spec-values")
        monthly = written(values.groupBy("basin", "station", F.trunc("date", "month").alias("date")).agg(F.avg("value").alias("value")).where("value IS NOT NULL"), "spec-months")
        table = written(M.survey_table(labels, monthly), "spec-table")
        marks = {"mode": F.lit(mode), "stack": F.lit(stack)}
        rows.append(table.withColumns(marks))
        days.append(wide_days(table, values).withColumns(marks))
    thresholds = labels.select(F.year("date").alias("year"), "band").distinct().withColumn("threshold", F.make_date("year", F.lit(6), F.lit(1)))
    return M.season_tables(reduce(DataFrame.unionByName, rows), thresholds), reduce(DataFrame.unionByName, days)


@query("m10_m12_specs_trained")
def _(spark, sf):
    """Every spec (band, mode, stack, season) trained, validated and used for every day, in three units."""
    by = ("basin", "band", "mode", "stack", "season")
    table, days = spec_table(spark, sf)
    table = written(table.select(*by, "date", "y", "x"), "spec-rows")
    chosen = M.train(table, by)
    pred = M.predict_days(table, chosen, days.select("basin", "mode", "stack", "date", "x"), by)
    return M.in_units(pred, areas(spark, sf)).join(chosen.select(*by, "features", "score", "r2", "rmse"), list(by))


MODEL_SQL = (
    CELLS_SQL
    + ", h AS (SELECT * FROM c WHERE date < DATE '2000-10-01')"
    + three_sql("h", 60)
    + ", days AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM c)"
    ", t AS (SELECT k.basin, k.station, y.date, c.value, c.g1, c.g2, c.g3 FROM (SELECT DISTINCT basin, station FROM c) k CROSS JOIN days y LEFT JOIN c USING (basin, station, date) WHERE y.date >= DATE '2000-10-01')"
    ", v AS (SELECT t.*, f.*EXCLUDE (basin, station), g1 - m1 AS d1, g2 - m2 AS d2, g3 - m3 AS d3 FROM t LEFT JOIN f USING (basin, station))"
    ", q AS (SELECT *, CASE WHEN g1 IS NOT NULL AND p0 IS NOT NULL THEN greatest(p0 + p1 * g1 + p2 * g2 + p3 * g3, 0) END AS pred, sigma * sqrt(1 + 1 / n + greatest((i11 * d1 * d1 + i22 * d2 * d2 + i33 * d3 * d3 + 2 * (i12 * d1 * d2 + i13 * d1 * d3 + i23 * d2 * d3)) / (det * n), 0)) AS se FROM v)"
    ", r AS (SELECT *, CASE WHEN value IS NULL THEN 'MISSING' WHEN value < 0 OR value > 3000 THEN 'PHYSICAL' WHEN pred IS NULL OR se IS NULL OR pred < 10 THEN 'SKIPPED' WHEN abs(value - pred) > greatest(2 * se * 1.2, 25, 0.05 * greatest(abs(pred), 1)) THEN 'PRED_RESID' ELSE 'OK' END AS reason_code FROM q)"
    " SELECT basin, station, date, method, round(pred, 3) AS pred, round(se, 3) AS se, reason_code, CAST(reason_code NOT IN ('OK', 'SKIPPED') AS INTEGER) AS flag FROM r, (VALUES ('base'), ('detrend')) w(method)"
)


def model_flags(spark, sf, methods):
    days = written(daily_calendar(with_cells(spark, sf)), "model-days")
    hist, test = days.where("date < '2000-10-01'"), days.where("date >= '2000-10-01'")
    parts = [Q.model_qa(hist, test, CELLS, m, gate=10.0).withColumn("method", F.lit(m)) for m in methods]
    columns = ["basin", "station", "date", "method", F.round("pred", 3).alias("pred"), F.round("se", 3).alias("se"), "reason_code", "flag"]
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


@query("q3_model_qa", MODEL_SQL)
def _(spark, sf):
    return model_flags(spark, sf, ("base", "detrend"))


@query("q3_model_seasonal")
def _(spark, sf):
    return model_flags(spark, sf, ("seasonal",))


def methods_sql() -> str:
    """The union of the three methods' SQL with the driver's gates and the operators' own limits."""
    static = STATIC.replace("quantile_cont(d, 0.05)", "quantile_cont(d, 0.005)").replace("quantile_cont(d, 0.95)", "quantile_cont(d, 0.995)").replace("lo * 1.0", "lo * 1.5").replace("hi * 1.0", "hi * 1.5").replace("value > 90", "value > 3000")
    voting = VOTING.replace("value > 90", "value > 3000").replace("value < 20 AND value - delta < 20", "value < 50 AND value - delta < 50")
    base = MODEL_SQL.replace("pred < 10", "pred < 50").replace("(VALUES ('base'), ('detrend'))", "(VALUES ('model'))")
    parts = {"static": f"{with_views(*FULL)}{static} SELECT * FROM static", "voting": f"{with_views(*FULL)}{voting} SELECT * FROM voting", "model": base}
    rows = " UNION ALL ".join(f"SELECT basin, station, date, '{name}' AS method, reason_code FROM ({sql})" for name, sql in parts.items())
    return f"SELECT *, CASE reason_code WHEN 'OK' THEN 0 WHEN 'SKIPPED' THEN 0 WHEN 'MISSING' THEN 2 WHEN 'PHYSICAL' THEN 2 WHEN 'DELTA' THEN 2 ELSE 1 END AS severity, CAST(reason_code NOT IN ('OK', 'SKIPPED') AS INTEGER) AS flag FROM ({rows})"


@query("q5_all_methods", methods_sql())
def _(spark, sf):
    days = written(daily_calendar(with_cells(spark, sf)), "qa-days")
    hist, test = days.where("date < '2000-10-01'"), days.where("date >= '2000-10-01'")
    return Q.run_qa(hist, test, ranking(history(spark, sf)), CELLS)

