"""Linear models as distributed jobs: least squares from aggregated moments, gap filling, selection, cross-validation.

Fits never gather raw rows on one place: Spark aggregates means and covariances for each group, and only the k x k
solve of one such row runs in numpy. Selection works on survey tables, which have one row a survey date: folds, station
sets and test years are sums and parts of the years' Gram matrices (``folds``), blocks of station subsets are rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.units import FACTORS
from fieldspark.operators.folds import SPAN, fold_fits, held_out, in_span, one_ask, survey_grams, with_years
from fieldspark.operators.gapfill import impute_from_peers
from fieldspark.operators.joins import season_part
from fieldspark.operators.linear import adjusted, lstsq, r2_of, solve
from fieldspark.sources.tables import exists, small_side, written

__all__ = ["impute_from_peers"]

KEYS = ("basin", "station")


def moments(df: DataFrame, by: Sequence[str], y: str, xs: Sequence[str]) -> DataFrame:
    """(by, n, mean, cov): of the complete rows; mean and cov (population, row by row) in the order y, xs."""
    names = [y, *xs]
    full = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names]))
    cov = [F.covar_pop(a, b) for a in names for b in names]
    return full.groupBy(*by).agg(F.count("*").alias("n"), F.array(*[F.avg(c) for c in names]).alias("mean"), F.array(*cov).alias("cov"))


def fit_ols(df: DataFrame, by: Sequence[str], y: str, xs: Sequence[str], min_n: int = 1) -> DataFrame:
    """Least squares with intercept for each group (M1): (by, n, intercept, beta, sigma, mean, inverse)."""
    stats = moments(df, by, y, xs).where(F.col("n") >= min_n)
    k = len(xs)
    kinds = dict(stats.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fits = [solve(int(n), np.array(m), np.array(c).reshape(k + 1, k + 1)) for n, m, c in zip(pdf["n"], pdf["mean"], pdf["cov"], strict=True)]
            out = pdf[[*by, "n"]].copy()
            out["intercept"] = [f[0] for f in fits]
            out["beta"] = [f[1] for f in fits]
            out["sigma"] = [None if np.isnan(f[2]) else f[2] for f in fits]
            out["mean"] = [np.array(m)[1:] for m in pdf["mean"]]
            out["inverse"] = [f[3].ravel() for f in fits]
            yield out

    schema = ", ".join(f"{c} {kinds[c]}" for c in by) + ", n long, intercept double, beta array<double>, sigma double, mean array<double>, inverse array<double>"
    return stats.mapInPandas(run, schema)


def predict(xs: Sequence[str], intercept: Column, beta: Column) -> Column:
    """intercept + beta . x; null if a predictor is null."""
    return reduce(lambda a, b: a + b, [F.get(beta, F.lit(i)) * F.col(x) for i, x in enumerate(xs)], intercept)


def interval_score(df: DataFrame, fits: DataFrame, by: Sequence[str], xs: Sequence[str]) -> DataFrame:
    """``df`` with pred and se, the standard error of a new observation: sigma sqrt(1 + 1/n + d' inverse d) (M1, Q3)."""
    k = len(xs)
    joined = df.join(small_side(written(fits, "fits")), list(by), "left")
    d = [F.col(x) - F.get("mean", F.lit(i)) for i, x in enumerate(xs)]
    quad = reduce(lambda a, b: a + b, [d[i] * d[j] * F.get("inverse", F.lit(i * k + j)) for i in range(k) for j in range(k)])
    se = F.col("sigma") * F.sqrt(1 + 1 / F.col("n") + F.greatest(quad, F.lit(0.0)))
    return joined.withColumns({"pred": predict(xs, F.col("intercept"), F.col("beta")), "se": se}).drop("n", "intercept", "beta", "sigma", "mean", "inverse")


def fitted(df: DataFrame, by: Sequence[str], y: str, xs: Sequence[str], clip: bool = False) -> DataFrame:
    """In-sample fit on all predictors: ``df`` with yhat and resid (M4)."""
    fits = written(fit_ols(df, by, y, xs).select(*by, "intercept", "beta"), "fits")
    out = df.join(small_side(fits), list(by), "left").withColumn("yhat", predict(xs, F.col("intercept"), F.col("beta"))).drop("intercept", "beta")
    if clip:
        out = out.withColumn("yhat", F.when(F.col("yhat").isNotNull(), F.greatest("yhat", F.lit(0.0))))
    return out.withColumn("resid", F.col(y) - F.col("yhat"))


# Imputation


def impute_from_grid(rows: DataFrame, history: DataFrame, predictors: Sequence[str], since: str = "2013-01-01", min_n: int = 20, value: str = "value") -> DataFrame:
    """Missing values of ``rows`` by regression on their grid cells (M3).

    One fit a station over the history from ``since`` on with at least ``min_n`` complete days; predictions are
    clipped at zero and made where all predictors exist. Adds ``imputed``.
    """
    fits = written(fit_ols(history.where(F.col("date") >= F.lit(since).cast("date")), KEYS, value, predictors, min_n).select(*KEYS, "intercept", "beta"), "fits")
    out = rows.join(small_side(fits), list(KEYS), "left").withColumn("__p", predict(predictors, F.col("intercept"), F.col("beta")))
    fill = F.when(F.col(value).isNull() & F.col("__p").isNotNull(), F.greatest("__p", F.lit(0.0)))
    return out.withColumn("imputed", fill.isNotNull()).withColumn(value, F.coalesce(value, fill)).drop("intercept", "beta", "__p")


# Selection over survey tables: rows (group..., date, y, x array<double>) with one array position a station


def survey_table(labels: DataFrame, obs: DataFrame, by: Sequence[str] = ("basin", "band")) -> DataFrame:
    """One row a (basin, band, date) with the survey value and the stations' values in order of id.

    Stations are those that have a value on every survey date of the basin; others would void the row.
    """
    dates = labels.select("basin", "date").distinct()
    values = obs.where("value IS NOT NULL").join(dates, ["basin", "date"], "left_semi")
    n = dates.groupBy("basin").agg(F.count("*").alias("__n"))
    full = values.groupBy("basin", "station").agg(F.count_distinct("date").alias("__m")).join(n, "basin").where("__m = __n").select("basin", "station")
    rows = values.join(full, ["basin", "station"]).groupBy("basin", "date").agg(F.sort_array(F.collect_list(F.struct("station", "value"))).alias("__v"))
    x = F.transform("__v", lambda s: s["value"].cast("double"))
    ids = F.transform("__v", lambda s: s["station"])
    return labels.join(rows.select("basin", "date", x.alias("x"), ids.alias("stations")), ["basin", "date"]).select(*by, "date", F.col("value").cast("double").alias("y"), "x", "stations")


def loyo_select(table: DataFrame, by: Sequence[str] = ("basin", "band"), most: int | None = None, asks: DataFrame | None = None, grams: DataFrame | None = None) -> DataFrame:
    """Leave-one-year-out selection (M7): rows (by, fold, date, y, pred, features), with ``ask`` behind ``by`` if ``asks`` are given.

    Each fold is a calendar year; missing predictors count as zero; predictions are clipped at zero; dates stay with
    their rows. A group of one year is predicted as zero. Features are positions in ``x``. Folds are solved on sums of
    the years' Gram matrices (``folds``; ``grams`` if they are at hand).
    """
    grams = written(survey_grams(table, by), "loyo-grams") if grams is None else grams
    fits = written(fold_fits(grams, one_ask(table, by) if asks is None else asks, by, most), "loyo-fits")
    out = held_out(table, fits, by)
    return out.drop("ask") if asks is None else out


def loo(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Leave-one-out predictions in closed form; a row of leverage one is refitted without it (M9)."""
    a = np.column_stack([np.ones(len(x)), x])
    q, s, _ = np.linalg.svd(a, full_matrices=False)
    q = q[:, s > s.max() * 1e-12]
    h = (q**2).sum(axis=1)
    p = q @ (q.T @ y)
    bad = h > 1 - 1e-9
    out = (p - h * y) / np.where(bad, 1, 1 - h)
    for i in np.flatnonzero(bad):
        rest = np.arange(len(y)) != i
        b = lstsq(x[rest], y[rest])
        out[i] = b[0] + x[i] @ b[1:]
    return out


def loo_score(x: np.ndarray, y: np.ndarray) -> float:
    """Adjusted r² of the leave-one-out predictions, clipped at zero (M8)."""
    n, k = x.shape
    return round(adjusted(r2_of(y, np.maximum(loo(x, y), 0)), n, k), 12)


def subset_at(rank: int, stations: Sequence[int], most: int) -> list[int]:
    """The rank-th subset of size 1 to ``most``: by size, then in lexicographic order."""
    for size in range(1, most + 1):
        if rank < comb(len(stations), size):
            break
        rank -= comb(len(stations), size)
    out, at = [], 0
    while len(out) < size:
        n = comb(len(stations) - at - 1, size - len(out) - 1)
        if rank < n:
            out.append(stations[at])
        else:
            rank -= n
        at += 1
    return out


def fold_stations(cv: DataFrame, by: Sequence[str] = ("basin", "band")) -> DataFrame:
    """How many folds chose each station: (by, feature, n_folds), most frequent first."""
    folds = cv.select(*by, "fold", "features").distinct()
    return folds.select(*by, F.explode("features").alias("feature")).groupBy(*by, "feature").agg(F.count("*").alias("n_folds")).orderBy(*by, F.desc("n_folds"), "feature")


def survey_arrays(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, wy, y, x): a group's surveys as arrays, in order of date."""
    rows = with_years(table.where("y IS NOT NULL")).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("date", "wy", "y", "x"))).alias("rows"))  # a group's surveys
    return rows.select(*by, F.col("rows.wy").alias("wy"), F.col("rows.y").alias("y"), F.col("rows.x").alias("x"))


def surveys(wy, y, x, before, without) -> tuple[np.ndarray, np.ndarray]:
    """(x with missing as nan, y) of the surveys that count."""
    y, x = np.array(y, float), np.array(list(x), float).reshape(len(y), -1)
    ok = in_span(wy, before, without)
    return x[ok], y[ok]


def unbounded(chosen: DataFrame) -> DataFrame:
    """``chosen`` with the columns ``before`` and ``without``, null where it has none."""
    return chosen.withColumns({c: F.lit(None).cast("int") for c in SPAN if c not in chosen.columns})


def best_subset(table: DataFrame, cv: DataFrame, by: Sequence[str] = ("basin", "band"), most: int = 5, block: int = 512, asks: DataFrame | None = None) -> DataFrame:
    """The station subset of greatest adjusted leave-one-out r² among those that any fold chose (M8a): (by, [ask, before, without], features, score).

    Subsets are numbered and dealt in blocks of ``block`` numbers, each block a row that any task can score; the
    survey table of its group rides along as arrays, and serves all asks. Of equal scores the lowest number wins.
    """
    keys = [*by, "ask"] if asks is not None else list(by)
    used = fold_stations(cv, keys).groupBy(*keys).agg(F.sort_array(F.collect_set("feature")).alias("used"))
    used = used.join(asks.select(*keys, *SPAN), keys) if asks is not None else unbounded(used)
    n = F.size("used")
    total = F.lit(0).cast("long")
    c = F.lit(1).cast("double")
    for size in range(1, most + 1):
        c = c * (n - size + 1) / size
        total = total + F.greatest(F.round(c), F.lit(0.0)).cast("long")
    blocks = used.withColumn("total", total).select(*keys, *SPAN, "used", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(block).cast("long"))).alias("lo"))
    work = blocks.join(survey_arrays(table, by), list(by)).repartition(*keys, "lo")
    kinds = dict(work.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            best = []
            for used_, total_, lo, *rows in zip(*[pdf[c] for c in ("used", "total", "lo", "wy", "y", "x", *SPAN)], strict=True):
                x, y = surveys(*rows)
                x, used_ = np.nan_to_num(x), [int(i) for i in used_]
                scored = ((loo_score(x[:, s], y), -r, s) for r in range(lo, min(total_, lo + block)) for s in (subset_at(r, used_, most),))
                best.append(max(scored, key=lambda t: t[:2]))
            yield pdf[[*keys, *SPAN]].assign(score=[b[0] for b in best], rank=[-b[1] for b in best], features=[b[2] for b in best])

    schema = ", ".join(f"{c} {kinds[c]}" for c in (*keys, *SPAN)) + ", score double, rank long, features array<int>"
    scored = work.mapInPandas(run, schema)
    out = scored.groupBy(*keys, *SPAN).agg(F.max_by(F.struct("features", "score"), F.struct("score", -F.col("rank"))).alias("b")).select(*keys, *SPAN, "b.features", "b.score")
    return out if asks is not None else out.drop(*SPAN)


def frequent_subset(table: DataFrame, cv: DataFrame, by: Sequence[str] = ("basin", "band")) -> DataFrame:
    """Stations added by how many folds chose them while the score improves (M8b): (by, features, score)."""
    order = fold_stations(cv, by).groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n_folds")).alias("n"), "feature"))), lambda s: s["feature"]).alias("used"))
    data = table.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("date", "y", "x"))).alias("rows")).select(*by, F.col("rows.y").alias("y"), F.col("rows.x").alias("x"))
    kinds = dict(table.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for used, y, x in zip(pdf["used"], pdf["y"], pdf["x"], strict=True):
                y, x = np.array(y, float), np.nan_to_num(np.array(list(x), float))
                chosen, best = [], -np.inf
                for i in map(int, used):
                    score = loo_score(x[:, [*chosen, i]], y)
                    if score > best:
                        chosen, best = [*chosen, i], score
                out.append((chosen, best))
            yield pdf[list(by)].assign(features=[o[0] for o in out], score=[o[1] for o in out])

    schema = ", ".join(f"{c} {kinds[c]}" for c in by) + ", features array<int>, score double"
    return order.join(data, list(by)).select(*by, "used", "y", "x").mapInPandas(run, schema)


def fit_chosen(table: DataFrame, chosen: DataFrame, by: Sequence[str] = ("basin", "band"), zero_row: bool = True) -> DataFrame:
    """``chosen`` (by, [ask, before, without], features) with ``intercept`` and ``beta``: the fit that predicts days.

    Surveys without a value or without one of the chosen stations are left out; with ``zero_row`` an all-zero survey is
    added.
    """
    work = unbounded(chosen).join(survey_arrays(table, by), list(by))
    kinds = dict(work.dtypes)
    names = [c for c in work.columns if c not in ("wy", "y", "x")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fits = []
            for f, *rows in zip(*[pdf[c] for c in ("features", "wy", "y", "x", *SPAN)], strict=True):
                x, y = surveys(*rows)
                x = x[:, [int(i) for i in f]]
                ok = ~np.isnan(x).any(axis=1)
                x, y = x[ok], y[ok]
                if zero_row:
                    x, y = np.vstack([x, np.zeros((1, x.shape[1]))]), np.append(y, 0.0)
                fits.append(lstsq(x, y) if len(y) else np.full(x.shape[1] + 1, np.nan))
            yield pdf[names].assign(intercept=[None if np.isnan(b[0]) else b[0] for b in fits], beta=[b[1:] for b in fits])

    fits = work.mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in names) + ", intercept double, beta array<double>")
    return fits.drop(*[c for c in SPAN if c not in chosen.columns])


def served(days: DataFrame, fits: DataFrame, keys: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """Days with the predictions of their fits (M12): (keys, columns, date, pred), clipped at zero.

    ``days`` has the date, x in the order of the table's stations and those of the keys that it depends on. A day whose
    keys have no fit, or that lacks a chosen station, has a null prediction.
    """
    joined = days.join(small_side(written(fits, "day-fits")), [c for c in keys if c in days.columns], "left")
    terms = F.zip_with("features", "beta", lambda f, b: F.get("x", f) * b)
    pred = F.aggregate(terms, F.col("intercept"), lambda a, t: a + t)
    return joined.select(*keys, *columns, "date", F.when(pred.isNotNull(), F.greatest(pred, F.lit(0.0))).alias("pred"))


def predict_days(table: DataFrame, chosen: DataFrame, days: DataFrame, by: Sequence[str] = ("basin", "band"), zero_row: bool = True) -> DataFrame:
    """Daily predictions with the chosen stations (M12): (by, date, pred), clipped at zero; days of groups without a choice are left out.

    One fit a group (``fit_chosen``); scaling by a factor scales the result, so units are converted afterwards (``in_units``).
    """
    return served(days, fit_chosen(table, chosen.select(*by, "features"), by, zero_row), by).where(F.col(by[-1]).isNotNull())


def in_units(pred: DataFrame, areas: DataFrame, by: Sequence[str] = ("basin", "band")) -> DataFrame:
    """Predictions in mm as mm, inches and, over the group's area (``area_m2``), acre-feet."""
    mm = F.col("pred")
    joined = pred.join(small_side(written(areas.select(*by, "area_m2"), "areas")), list(by), "left")
    acre_feet = mm * 0.001 * F.col("area_m2") * F.lit(FACTORS["m3", "acreft"])
    return joined.select("*", mm.alias("mm"), (mm * F.lit(FACTORS["mm", "in"])).alias("inches"), acre_feet.alias("acre_ft")).drop("pred", "area_m2")


def validate(table: DataFrame, chosen: DataFrame, by: Sequence[str] = ("basin", "band"), grams: DataFrame | None = None) -> DataFrame:
    """The selection by years run again inside the chosen stations (M8): (by, [ask], n, r2, rmse) of its held-out predictions.

    As in the original procedure each fold may take fewer of them; negative predictions are zero before any statistic.
    """
    keys = [*by, "ask"] if "ask" in chosen.columns else list(by)
    asks = unbounded(chosen if "ask" in chosen.columns else chosen.withColumn("ask", F.lit(""))).select(*by, "ask", F.col("features").alias("use"), *SPAN)
    held = loyo_select(table, by, asks=asks, grams=grams)
    r = F.corr("pred", "y")
    r2 = F.when(r.isNull() | F.isnan(r), 0.0).otherwise(r * r)
    return held.groupBy(*keys).agg(F.count("*").alias("n"), r2.alias("r2"), F.sqrt(F.avg(F.pow(F.col("pred") - F.col("y"), 2))).alias("rmse"))


def train(table: DataFrame, by: Sequence[str] = ("basin", "band"), most: int = 5, asks: DataFrame | None = None) -> DataFrame:
    """The whole training of each group: selection by years, best subset, validation (M10): (by, [ask, before, without], features, score, n, r2, rmse).

    ``asks`` (see ``folds``) train a group several times, on other stations or other years.
    """
    table = written(table, "train-table")
    grams = written(survey_grams(table, by), "train-grams")
    cv = written(loyo_select(table, by, asks=asks, grams=grams), "train-folds")
    chosen = written(best_subset(table, cv, by, most, asks=asks), "train-chosen")
    return chosen.join(validate(table, chosen, by, grams), [*by, "ask"] if asks is not None else list(by))


# Trained models as a table


def data_key(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, data): a number that changes with the group's surveys, so that stored models of other surveys aren't used."""
    return table.groupBy(*by).agg(F.sum(F.xxhash64("date", "y", "x").cast("decimal(20,0)")).cast("string").alias("data"))


def stored_models(table: DataFrame, asks: DataFrame, path: str, by: Sequence[str] = ("basin", "band"), most: int = 5, zero_row: bool = True) -> DataFrame:
    """Coefficients of all ``asks`` (M11): (by, ask, data, features, intercept, beta, score, n, r2, rmse), kept as Parquet under ``path``.

    Only asks that the table of earlier runs lacks (an anti-join on the group, the ask and the key of its surveys) are
    trained and appended; a run without new ones trains nothing. One writer at a time.
    """
    spark = table.sparkSession
    keys = [*by, "ask", "data"]
    asks = written(asks.join(data_key(table, by), list(by)), "model-asks")
    missing = asks
    if exists(spark, path):
        missing = written(asks.join(spark.read.parquet(path).select(*keys), keys, "left_anti"), "model-missing")
    if not missing.isEmpty():
        fresh = train(table, by, most, missing.drop("data"))
        fits = fit_chosen(table, fresh, by, zero_row).join(missing.select(*keys), [*by, "ask"])
        fits.select(*keys, "features", "intercept", "beta", "score", "n", "r2", "rmse").write.mode("append").parquet(path)
    if not exists(spark, path):  # nothing was asked
        return asks.select(*keys).where(F.lit(False)).selectExpr("*", "CAST(NULL AS array<int>) features", "0D intercept", "CAST(NULL AS array<double>) beta", "0D score", "0L n", "0D r2", "0D rmse")
    return spark.read.parquet(path).join(asks.select(*keys), keys, "left_semi")


def station_sets(usable: DataFrame, baseline: DataFrame, by: Sequence[str] = ("basin",)) -> tuple[DataFrame, DataFrame]:
    """(distinct sets with their days' number, days with their set): one training serves all days of a set.

    A set is the usable stations of a day (rows of ``usable``) and those of them that are in ``baseline`` (by,
    station); ``set_key`` spells both out.
    """
    base = baseline.select(*by, "station").distinct().withColumn("__b", F.lit(True))
    rows = usable.select(*by, "date", "station").distinct().join(small_side(written(base, "baseline")), [*by, "station"], "left")
    listed = lambda c: F.sort_array(F.collect_list(F.when(c, F.col("station"))))
    days = rows.groupBy(*by, "date").agg(listed(F.lit(True)).alias("usable"), listed(F.col("__b")).alias("baseline"))
    days = days.withColumn("set_key", F.concat(set_text(F.col("usable")), F.lit("|"), set_text(F.col("baseline"))))
    sets = days.groupBy(*by, "set_key").agg(F.first("usable").alias("usable"), F.first("baseline").alias("baseline"), F.count("*").alias("n_days"))
    return sets, days.select(*by, "date", "set_key")


def set_asks(table: DataFrame, sets: DataFrame, by: Sequence[str] = ("basin", "band")) -> DataFrame:
    """Asks (see ``folds``) to train each group of ``table`` (by, stations) on each of its basin's station sets (basin, set).

    The ask is the set's text (``set_text``). Stations that the table lacks are left out; empty sets aren't asked for.
    """
    groups = table.groupBy(*by).agg(F.first("stations").alias("stations"))
    rows = groups.join(small_side(written(sets.select("basin", "set").distinct(), "ask-sets")), "basin")
    use = F.filter(F.transform("set", lambda s: (F.array_position("stations", s) - 1).cast("int")), lambda i: i >= 0)
    return unbounded(rows.select(*by, set_text(F.col("set")).alias("ask"), use.alias("use")).where(F.size("use") > 0)).select(*by, "ask", "use", *SPAN)


def set_text(stations: Column) -> Column:
    """A sorted array of stations as text."""
    return F.array_join(F.transform(stations, lambda s: s.cast("string")), ",")


def year_asks(table: DataFrame, years: DataFrame, by: Sequence[str] = ("basin", "band"), train: str = "earlier") -> DataFrame:
    """Asks (see ``folds``) to train each group for each test water year ``wy`` of ``years`` (M15, F2): on earlier water years, or on all others.

    The ask is the year. Years without surveys to train on are left out.
    """
    own = with_years(table).groupBy(*by).agg(F.collect_set("wy").alias("own"))
    test = F.col("test")
    rows = own.join(F.broadcast(years.agg(F.collect_set(F.col("wy").cast("int")).alias("tests")))).withColumn("test", F.explode("tests"))
    rows = rows.where(F.exists("own", lambda y: y < test if train == "earlier" else y != test))
    none = F.lit(None).cast("int")
    return rows.select(*by, test.cast("string").alias("ask"), F.lit(None).cast("array<int>").alias("use"), (test if train == "earlier" else none).alias("before"), (none if train == "earlier" else test).alias("without"))


def season_tables(table: DataFrame, thresholds: DataFrame, seasons: Sequence[str] = ("season", "accum", "melt")) -> DataFrame:
    """``table`` once a season, with the column ``season``: all rows, those before, those from the threshold on.

    ``thresholds`` is (year, band, threshold).
    """
    keyed = table.withColumn("year", F.year("date"))
    parts = [keyed if s == "season" else season_part(keyed, thresholds, s, ("year", "band")).drop("threshold") for s in seasons]
    return reduce(lambda a, b: a.unionByName(b), [p.drop("year").withColumn("season", F.lit(s)) for p, s in zip(parts, seasons, strict=True)])


def model_specs(table: DataFrame, modes: Sequence[str] = ("drop", "impute"), stacks: Sequence[str] = ("peers", "grid"), seasons: Sequence[str] = ("season", "accum", "melt")) -> DataFrame:
    """Every (basin, band, mode, stack, season) to train."""
    out = table.select("basin", "band").distinct()
    for name, values in (("mode", modes), ("stack", stacks), ("season", seasons)):
        out = out.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    return out


def training_report(table: DataFrame, by: Sequence[str], y: str, xs: Sequence[str], test: DataFrame) -> DataFrame:
    """Train rows with fit and residual, then the test rows with their prediction."""
    fits = small_side(written(fit_ols(table, by, y, xs).select(*by, "intercept", "beta"), "fits"))
    score = lambda d, kind: d.join(fits, list(by)).withColumns({"model": F.lit(kind), "yhat": predict(xs, F.col("intercept"), F.col("beta"))}).drop("intercept", "beta")
    train = score(table, "train").withColumn("resid", F.col(y) - F.col("yhat"))
    return train.unionByName(score(test.withColumn(y, F.lit(None).cast("double")), "test").withColumn("resid", F.lit(None).cast("double")))
