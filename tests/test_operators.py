"""Ties, thresholds and edges on small tables, and models against numpy."""

import datetime as dt
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import plain_models as plain
import pytest
from pyspark.sql import functions as F

from fieldspark.functions import clean, units
from fieldspark.operators import aggregates, calendars, joins, models, peers, qa, sequences
from fieldspark.streaming.daily import daily_stream

D = dt.date


def days(spark, values, start=D(2020, 1, 1), basin=1, station=1):
    rows = [(basin, station, start + dt.timedelta(i), v if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "basin int, station int, date date, value double")


def by_date(df, column):
    return [r[column] for r in df.orderBy("date").collect()]


def test_null_to_value_and_first_day(spark):
    df = days(spark, [None, 1.0, 2.0, None, None, 3.0])
    df = df.withColumns({"a": sequences.null_to_value(F.col("value")), "d": sequences.row_difference(F.col("value"), first_is_zero=True)})
    assert by_date(df, "a") == [False, True, False, False, False, True]
    assert by_date(df, "d") == [None, None, 1.0, None, None, None]


@pytest.mark.parametrize(("flags", "want"), [([1, 1, 0, 1, 1, 1], [0, 0, 0, 1, 1, 1]), ([1, 1, 1], [1, 1, 1]), ([0, 1, 1, 0], [0, 0, 0, 0]), ([1], [0])])
def test_runs(spark, flags, want):
    df = days(spark, [float(f) for f in flags]).withColumn("flag", F.col("value").cast("int"))
    assert by_date(sequences.long_runs(df, "flag", 3), "persistent") == want


def test_run_broken_by_missing_day(spark):
    flags = days(spark, [1.0, 1.0, 1.0, 1.0]).where("date <> '2020-01-03'").withColumns({"flag": F.lit(1), "method": F.lit("static")})
    flags = flags.unionByName(flags.withColumn("method", F.lit("voting"))).drop("value")
    out = qa.mask_persistent(days(spark, [5.0] * 4), flags, 2)
    assert by_date(out, "masked") == [1, 1, 0, 0]
    assert by_date(qa.mask_persistent(days(spark, [5.0] * 4), flags, 3), "value") == [5.0] * 4


def test_widen_lonely(spark):
    df = days(spark, [0.0, 0, 1, 0, 0, 1, 1, 0]).withColumn("f", F.col("value").cast("int"))
    assert by_date(df.withColumn("w", sequences.widen_lonely(F.col("f"))), "w") == [0, 1, 1, 1, 0, 1, 1, 0]


@pytest.mark.parametrize(("tie", "want"), [("later", D(2020, 1, 5)), ("earlier", D(2020, 1, 1))])
def test_nearest_tie_and_far(spark, tie, want):
    left = spark.createDataFrame([(1, D(2020, 1, 3)), (1, D(2025, 1, 1)), (2, D(2020, 1, 1))], "k int, date date")
    right = spark.createDataFrame([(1, D(2020, 1, 1), 1.0), (1, D(2020, 1, 5), 2.0), (1, D(2020, 1, 3), None)], "k int, date date, value double")
    got = {(r.k, r.date): r.near_date for r in joins.nearest(left, right, ["k"], tie=tie).collect()}
    assert got == {(1, D(2020, 1, 3)): want, (1, D(2025, 1, 1)): D(2020, 1, 5), (2, D(2020, 1, 1)): None}


def test_thresholds_repeat_and_their_own_date(spark):
    t = spark.createDataFrame([(2020, 0, D(2020, 1, 2))] * 2, "year int, elev_bin int, threshold date")
    df = days(spark, [1.0, 2.0, 3.0]).withColumns({"year": F.year("date"), "elev_bin": F.lit(0)})
    assert by_date(joins.season_part(df, t, "accum"), "value") == [1.0]
    assert by_date(joins.season_part(df, t, "melt"), "value") == [2.0, 3.0]


def test_exclusion_open_ends(spark):
    ranges = spark.createDataFrame([(1, None, D(2020, 1, 1)), (1, D(2020, 1, 4), None)], "station int, start date, end date")
    assert by_date(calendars.exclude(days(spark, [1.0, 2.0, 3.0, 4.0, 5.0]), ranges), "value") == [None, 2.0, 3.0, None, None]


def test_spread_rules(spark):
    df = days(spark, [1.0] * 12)
    assert peers.robust_sigma(df, ["station"], "value", 5, True).first().sigma is None
    assert peers.robust_sigma(df, ["station"], "value", 10, False).first().sigma == 0.0
    assert peers.robust_sigma(df.limit(4), ["station"], "value", 5, True).first().sigma is None
    assert peers.quantile_bounds(df.limit(9), ["station"], "value").first().lo is None


def test_zero_variance_peer_is_left_out(spark):
    a, b = days(spark, list(map(float, range(10)))), days(spark, [7.0] * 10, station=2)
    assert peers.pair_stats(a.unionByName(b), "value", 5).count() == 0


def test_clip_and_sentinels(spark):
    df = days(spark, [None, -1.0, 2.0, -9999.0, float("nan")])
    assert by_date(df.withColumn("c", units.clip_negative(clean.clean_value(F.col("value")))), "c") == [None, 0.0, 2.0, None, None]


def test_band_sum_adds_before_dividing(spark):
    df = spark.createDataFrame([("a", 1999.9), ("b", 1500.2), ("total", 3600.0)], "band string, value double").withColumn("k", F.lit(1))
    assert tuple(units.band_sum_taf(df, ["k"]).first())[1:] == (3, 3)


def test_band_edges(spark):
    bands = spark.createDataFrame([(0, "lo", float("-inf"), 10.0), (1, "hi", 10.0, float("inf"))], "ord int, band string, lo double, hi double")
    df = spark.createDataFrame([(9.999,), (10.0,), (1e9,)], "v double")
    assert [r.band for r in units.with_band(df, "v", bands).orderBy("v").collect()] == ["lo", "hi", "hi"]


def test_histogram_right_edge(spark):
    df = spark.createDataFrame([(float(i),) for i in range(5)], "v double")
    assert {r.bin: r.n for r in aggregates.histogram(df, "v", 4).collect()} == {0: 1, 1: 1, 2: 1, 3: 2}
    assert [tuple(r) for r in aggregates.histogram(df.where("v = 1"), "v", 4).collect()] == [(0, 1)]


def test_interpolation_keeps_the_ends(spark):
    df = days(spark, [None, 1.0, None, None, 4.0, None])
    assert by_date(calendars.interpolate(df), "value") == [None, 1.0, 2.0, 3.0, 4.0, None]


def test_physical_limits_are_inclusive(spark):
    df = qa.with_steps(days(spark, [0.0, 3000.0, 3000.1, -0.1, None]))
    out = qa.graded(df, "m", qa.hard_checks())
    assert by_date(out, "reason_code") == ["OK", "OK", "PHYSICAL", "PHYSICAL", "MISSING"]


def test_masking_is_idempotent_and_adds_nothing(spark):
    values = days(spark, [1.0, 2.0, None, 4.0, 5.0])
    flags = values.select("basin", "station", "date", F.explode(F.array(F.lit("static"), F.lit("voting"))).alias("method"), (F.col("value") > 3).cast("int").alias("flag")).na.fill(0)
    once = qa.mask_persistent(values, flags, 2)
    twice = qa.mask_persistent(once.select("basin", "station", "date", "value"), flags, 2)
    assert by_date(once, "value") == by_date(twice, "value") == [1.0, 2.0, None, None, None]


def rows_for_fit(spark, n=40, k=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k)) * 10
    y = 5 + x @ np.arange(1, k + 1) + rng.normal(size=n)
    pdf = pd.DataFrame(x, columns=[f"x{i}" for i in range(k)]).assign(value=y, basin=1, station=1, date=[D(2019, 1, 1) + dt.timedelta(i) for i in range(n)])
    return spark.createDataFrame(pdf), x, y


def test_ols_and_interval_match_numpy(spark):
    df, x, y = rows_for_fit(spark)
    xs = ["x0", "x1", "x2"]
    fits = models.fit_ols(df, models.KEYS, "value", xs)
    a = np.column_stack([np.ones(len(x)), x])
    b = np.linalg.lstsq(a, y, rcond=None)[0]
    f = fits.first()
    assert np.allclose([f.intercept, *f.beta], b)
    sigma = np.sqrt(((y - a @ b) ** 2).sum() / (len(y) - 4))
    se = sigma * np.sqrt(1 + np.einsum("ij,jk,ik->i", a, np.linalg.inv(a.T @ a), a))
    got = models.interval_score(df, fits, models.KEYS, xs).orderBy("date").toPandas()
    assert np.allclose(got["pred"], a @ b) and np.allclose(got["se"], se)


def test_ols_with_dependent_predictors(spark):
    df, x, y = rows_for_fit(spark, k=1)
    df = df.withColumn("x1", F.col("x0") * 2)
    out = models.fitted(df, models.KEYS, "value", ["x0", "x1"]).orderBy("date").toPandas()
    a = np.column_stack([np.ones(len(x)), x])
    assert np.allclose(out["yhat"], a @ np.linalg.lstsq(a, y, rcond=None)[0])


def test_loo_matches_refits():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(12, 2)), rng.normal(size=12)
    x[0] = [100, 0]
    x[1:, 1] = 0  # row of leverage one
    x[0, 1] = 5
    want = []
    for i in range(12):
        b = models.lstsq(np.delete(x, i, 0), np.delete(y, i))
        want.append(b[0] + x[i] @ b[1:])
    assert np.allclose(models.loo(x, y), want)


def test_subsets_are_numbered_like_combinations():
    stations = [2, 3, 5, 7, 11, 13]
    want = [list(c) for size in (1, 2, 3) for c in combinations(stations, size)]
    assert [models.subset_at(r, stations, 3) for r in range(sum(comb(6, s) for s in (1, 2, 3)))] == want


def survey(spark, n_years=6, per_year=4, k=4):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n_years * per_year):
        x = rng.uniform(0, 100, k)
        rows.append((1, "total", D(2010 + i // per_year, 1 + i % per_year, 1), float(3 + 2 * x[1] + x[2] + rng.normal()), [float(v) for v in x]))
    return spark.createDataFrame(rows, "basin int, band string, date date, y double, x array<double>"), rows


def test_selection_finds_the_stations(spark):
    table, rows = survey(spark)
    cv = models.loyo_select(table)
    assert cv.count() == len(rows)
    assert all({1, 2} <= set(r.features) for r in cv.collect())
    best = models.best_subset(table, cv, most=3).first()
    x, y = np.array([r[4] for r in rows]), np.array([r[3] for r in rows])
    used = sorted({f for r in cv.collect() for f in r.features})
    want = max((models.loo_score(x[:, list(s)], y), [-i for i in s]) for n in (1, 2, 3) for s in combinations(used, n))
    assert best.score == want[0]
    assert set(models.frequent_subset(table, cv).first().features) >= {1, 2}


def test_daily_prediction_uses_a_zero_row(spark):
    table, rows = survey(spark)
    chosen = spark.createDataFrame([(1, "total", [1, 2])], "basin int, band string, features array<int>")
    test = spark.createDataFrame([(1, D(2030, 1, 1), [0.0, 50.0, 10.0, 0.0]), (1, D(2030, 1, 2), [0.0, None, 1.0, 0.0])], "basin int, date date, x array<double>")
    out = models.predict_days(table, chosen, test).orderBy("date").collect()
    x, y = np.array([r[4] for r in rows])[:, 1:3], np.array([r[3] for r in rows])
    b = models.lstsq(np.vstack([x, [0, 0]]), np.append(y, 0))
    assert np.isclose(out[0].pred, b[0] + 50 * b[1] + 10 * b[2]) and out[1].pred is None


def test_peer_imputation_chains(spark):
    rng = np.random.default_rng(5)
    base = rng.uniform(10, 50, 60)
    series = {1: base, 2: base * 2 + 1, 3: base * 3}
    rows = [(1, s, D(2014, 1, 1) + dt.timedelta(i), float(v)) for s, vs in series.items() for i, v in enumerate(vs)]
    history = spark.createDataFrame(rows, "basin int, station int, date date, value double")
    day = D(2020, 5, 1)
    gaps = spark.createDataFrame([(1, 1, day, 20.0), (1, 2, day, None), (1, 3, day, None), (1, 4, day, None)], "basin int, station int, date date, value double")
    got = {r.station: (r.value, r.imputed) for r in models.impute_from_peers(gaps, history).collect()}
    assert got[1] == (20.0, False) and got[4] == (None, False)
    assert np.isclose(got[2][0], 41.0) and np.isclose(got[3][0], 60.0)


def plain_peers(wide, target, valid, since, most=3):
    """Chosen peers and their fit, by refits on the raw rows."""
    chosen, best = [], -np.inf
    for stage in range(most):
        scores = {}
        for p in [p for p in valid if p != target and p not in chosen]:
            part = wide[[target, *chosen, p]].dropna()
            part = part[part.index >= since] if stage else part
            if len(part) > stage + 2:
                y, x = part[target].to_numpy(), part[[*chosen, p]].to_numpy()
                b = models.lstsq(x, y)
                scores[p] = round(models.adjusted(models.r2_of(y, b[0] + x @ b[1:]), len(y), stage + 1), 10)
        top = max(scores, key=lambda p: (scores[p], -valid.index(p)), default=None)
        if top is None or scores[top] <= best:
            break
        best, chosen = scores[top], [*chosen, top]
    part = wide[[target, *chosen]].dropna()
    part = part[part.index >= since]
    return (chosen, models.lstsq(part[chosen].to_numpy(), part[target].to_numpy())) if chosen and len(part) > 1 else None


def test_peer_imputation_against_refits(spark):
    """All gaps of a network with random ones, a copied station (ties), chains of filled stations and whole days missing."""
    rng = np.random.default_rng(8)
    days = pd.date_range("2012-06-01", periods=400)
    level = np.cumsum(rng.normal(size=400)) + 50
    wide = pd.DataFrame({s: level * (1 + s / 10) + rng.normal(size=400) * s for s in range(1, 6)}, index=days)
    wide[6] = wide[2]
    wide = wide.mask(rng.random(wide.shape) < 0.25)
    wide.iloc[[7, 8]] = np.nan
    rows = [(1, int(s), d.date(), None if np.isnan(v) else float(v)) for d, row in wide.iterrows() for s, v in row.items()]
    df = spark.createDataFrame(rows, "basin int, station int, date date, value double")
    got = {(r.station, r.date): r for r in models.impute_from_peers(df, df).collect()}
    assert len(got) == len(rows)
    since, n = pd.Timestamp("2013-01-01"), 0
    for day, row in wide.iterrows():
        have = row.dropna().to_dict()
        able = bool(have)
        for s in wide.columns:
            r = got[s, day.date()]
            if s in row.dropna().index:
                assert (r.value, r.imputed) == (row[s], False)
                continue
            valid = sorted([*row.dropna().index, *[t for t in row[row.isna()].index if t < s]]) if able else []
            fit = plain_peers(wide, s, valid, since)
            if fit is None or any(p not in have for p in fit[0]):
                assert r.value is None and not r.imputed
                continue
            have[s] = max(0.0, float(fit[1][0] + sum(b * have[p] for b, p in zip(fit[1][1:], fit[0], strict=True))))
            assert r.imputed and np.isclose(r.value, have[s], atol=1e-6)
            n += 1
    assert n > 300


def test_training_of_specs_sets_and_years(spark):
    """Validation, seasons, test years, sets and units against their rules."""
    table, rows = survey(spark)
    by = ("basin", "band")
    out = models.train(table, by, 3).first()
    x, y = np.array([r[4] for r in rows]), np.array([r[3] for r in rows])
    p, _ = plain.loyo([r[2] for r in rows], x, y, sorted(out.features))
    assert out.n == len(y) and np.isclose(out.rmse, np.sqrt(np.mean((p - y) ** 2))) and np.isclose(out.r2, models.r2_of(y, p))
    limits = spark.createDataFrame([(r, "total", D(r, 3, 1)) for r in range(2010, 2014)], "year int, band string, threshold date")
    seasons = {r.season: r["count"] for r in models.season_tables(table, limits).groupBy("season").count().collect()}
    assert seasons == {"season": 24, "accum": 8, "melt": 8}
    wanted = spark.createDataFrame([(2010,), (2011,), (2013,)], "wy int")
    assert {(r.ask, r.before, r.without) for r in models.year_asks(table, wanted).collect()} == {("2011", 2011, None), ("2013", 2013, None)}
    assert {(r.ask, r.before, r.without) for r in models.year_asks(table, wanted, train="others").collect()} == {(str(y), None, y) for y in (2010, 2011, 2013)}
    sets, days = models.station_sets(
        spark.createDataFrame([(1, D(2020, 1, d), s) for d, ss in ((1, (12, 3)), (2, (1, 23)), (3, (3, 12)), (4, (12,))) for s in ss], "basin int, date date, station int"),
        spark.createDataFrame([(1, 3), (1, 9)], "basin int, station int"),
    )
    assert {(r.set_key, r.n_days) for r in sets.collect()} == {("3,12|3", 2), ("1,23|", 1), ("12|", 1)} and days.count() == 4
    stations = table.withColumn("stations", F.array(*[F.lit(s) for s in (3, 5, 9, 12)]))
    asked = models.set_asks(stations, spark.createDataFrame([(1, [9, 3, 4]), (1, []), (1, [4])], "basin int, set array<int>")).collect()
    assert [(r.ask, r.use) for r in asked] == [("9,3,4", [2, 0])]
    units = models.in_units(spark.createDataFrame([(1, "total", 100.0)], "basin int, band string, pred double"), spark.createDataFrame([(1, "total", 2500.0)], "basin int, band string, area_m2 double")).first()
    assert np.isclose(units.inches, 3.93701) and np.isclose(units.acre_ft, 100 * 0.001 * 2500 * 0.000810714) and units.mm == 100.0


def test_imputation_keeps_negative_out(spark):
    df, *_ = rows_for_fit(spark, k=1)
    rows = df.limit(1).select("basin", "station", "date", F.lit(None).cast("double").alias("value"), F.lit(-1000.0).alias("x0"))
    assert models.impute_from_grid(rows, df, ["x0"]).first().value == 0.0


def test_polygon_edges(spark):
    pts = spark.createDataFrame([(0.5, 0.5), (2.0, 0.5), (0.5, -0.5)], "lon double, lat double")
    assert joins.in_polygon(pts, [(0, 0), (1, 0), (1, 1), (0, 1)]).count() == 1


def test_daily_stream(spark, tmp_path):
    rows = [(1, "a", dt.datetime(2024, 1, d, h), float(h)) for d in (1, 2, 9) for h in (1, 3)]
    feed = spark.createDataFrame(rows, "station long, sensor string, ts timestamp, value double")
    want = {(r.date, r.value, r.n) for r in daily_stream(feed).collect()}
    feed.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = daily_stream(spark.readStream.schema(feed.schema).parquet(f"{tmp_path}/in"))
    q = stream.writeStream.format("memory").queryName("daily").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.date, r.value, r.n) for r in spark.table("daily").collect()}
    assert got == {w for w in want if w[0] < D(2024, 1, 7)}
