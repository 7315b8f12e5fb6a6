"""Selection, validation, stored models and daily predictions: whole results of the queries against refits in numpy."""

import datetime as dt
from collections import Counter

import numpy as np
import plain_models as plain
import pytest
from pyspark.sql import functions as F

from fieldspark.operators import folds, models
from fieldspark.operators.calendars import daily_calendar
from fieldspark.plans import QUERIES
from fieldspark.plans import models as queries
from fieldspark.sources import views

SF = "/root/testdata/sf0.001"
D = dt.date


def groups_of(table, by):
    """{group: (dates, x with nan for missing, y)}, in order of date."""
    out = {}
    for r in sorted((r for r in table.collect() if r.y is not None), key=lambda r: r.date):
        out.setdefault(tuple(r[c] for c in by), []).append((r.date, [np.nan if v is None else v for v in r.x], r.y))
    return {k: ([d for d, _, _ in v], np.array([x for _, x, _ in v], float), np.array([y for _, _, y in v], float)) for k, v in out.items()}


def water_year(d):
    return d.year + (d.month >= 10)


def check_training(row, dates, x, y, use=None):
    """A trained row (features, score, n, r2, rmse) against both passes and the search."""
    _, features = plain.loyo(dates, x, y, use)
    ties, top = plain.best_subset(x, y, features)
    assert list(row.features) in ties and np.isclose(row.score, top)
    pred, _ = plain.loyo(dates, x, y, sorted(row.features))
    again, _ = plain.loyo(dates, x, y, list(row.features))
    assert getattr(row, "n", len(y)) == len(y)  # some queries leave n out
    assert any(np.isclose(row.r2, plain.r2_of(y, p)) and np.isclose(row.rmse, np.sqrt(np.mean((p - y) ** 2))) for p in (pred, again))


def made(spark, n_years=5, per_year=5, k=6, seed=0, nulls=0.0):
    rng = np.random.default_rng(seed)
    rows = []
    for band in ("a", "b"):
        for i in range(n_years * per_year):
            x = [None if rng.random() < nulls else float(v) for v in rng.uniform(0, 100, k)]
            x[5] = None if x[4] is None else 2 * x[4]  # depends on another
            y = float(sum((j + 1) * (v or 0) for j, v in enumerate(x[:3])) - 150 + rng.normal() * 20)
            rows.append((1, band, D(2010 + i // per_year, 1 + 2 * (i % per_year), 3), y, x))
    return spark.createDataFrame(rows, "basin int, band string, date date, y double, x array<double>")


@pytest.mark.parametrize("nulls", [0.0, 0.2])
def test_folds_by_subtraction_are_refits(spark, nulls):
    table = made(spark, nulls=nulls)
    out = models.loyo_select(table).collect()
    want = {k: plain.loyo(*v) for k, v in groups_of(table, ("basin", "band")).items()}
    got = {(r.basin, r.band, r.date): r for r in out}
    assert len(got) == len(out) == 50 and any(r.pred == 0 for r in out)
    for k, (dates, _, _) in groups_of(table, ("basin", "band")).items():
        pred, features = want[k]
        for d, p in zip(dates, pred, strict=True):
            assert list(got[(*k, d)].features) == features[d.year] and np.isclose(got[(*k, d)].pred, p, atol=1e-6)


def test_asks_restrict_stations_and_years(spark):
    table = made(spark)
    asks = [("some", [0, 3, 4], None, None), ("early", None, 2013, None), ("others", None, None, 2012), ("one year", None, 2011, None), ("none", None, 2000, None)]
    df = spark.createDataFrame([(1, b, *a) for b in "ab" for a in asks], "basin int, band string, ask string, use array<int>, before int, without int")
    cv = models.loyo_select(table, asks=df).collect()
    trained = {(r.band, r.ask): r for r in models.train(table, asks=df).collect()}
    for (_, band), (dates, x, y) in groups_of(table, ("basin", "band")).items():
        wy = np.array([water_year(d) for d in dates])
        for name, use, before, without in asks:
            ok = (wy < (before or 9999)) & (wy != (without or 0))
            own = [d for d, o in zip(dates, ok, strict=True) if o]
            got = {r.date: r for r in cv if (r.band, r.ask) == (band, name)}
            assert sorted(got) == own
            if not own:
                continue
            pred, features = plain.loyo(own, x[ok], y[ok], use)
            assert all(np.isclose(got[d].pred, p, atol=1e-6) and list(got[d].features) == features[d.year] for d, p in zip(own, pred, strict=True))
            if any(features.values()):
                check_training(trained[band, name], own, x[ok], y[ok], use)
            else:
                assert (band, name) not in trained


def test_grow_with_dependent_and_constant_stations():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(12, 4)) * [1, 100, 1, 1]
    x[:, 2], x[:, 3] = x[:, 0], 7.0
    y = x[:, 0] * 3 + x[:, 1] + rng.normal(size=12)
    gram = lambda a, b: (m := np.column_stack([np.ones(len(b)), b, a])).T @ m
    chosen, b0, beta = folds.grow(gram(x[:9], y[:9]), gram(x[9:], y[9:]), range(4))
    assert chosen[:2] == plain.grow(x[:9], y[:9], x[9:], y[9:], range(4))[:2]
    b = plain.lstsq(x[:9][:, chosen], y[:9])
    assert np.allclose(b0 + x[:, chosen] @ beta, b[0] + x[:, chosen] @ b[1:])
    assert folds.grow(gram(x, y) * 0, gram(x, y), range(4))[0] == []


def test_missing_training_rows_are_dropped(spark):
    rows = [(1, "t", D(2010, 1, i + 1), 10.0 * i, [float(i), None if i % 3 == 0 else 2.0 * i + i % 2]) for i in range(9)]
    table = spark.createDataFrame(rows, "basin int, band string, date date, y double, x array<double>")
    chosen = spark.createDataFrame([(1, "t", [0, 1])], "basin int, band string, features array<int>")
    test = spark.createDataFrame([(1, D(2030, 1, 1), [3.0, 5.0])], "basin int, date date, x array<double>")
    pred = models.predict_days(table, chosen, test).first().pred
    b = plain.final_fit(np.array([[np.nan if v is None else v for v in r[4]] for r in rows]), np.array([r[3] for r in rows]), [0, 1])
    assert np.isclose(pred, b[0] + 3 * b[1] + 5 * b[2])


def test_one_station_prediction_matches_sql(spark):
    """With one station the fit has a closed form: regr_slope over the surveys and the zero row."""
    import duckdb

    table = made(spark, seed=7, nulls=0.1)
    chosen = spark.createDataFrame([(1, "a", [0]), (1, "b", [2])], "basin int, band string, features array<int>")
    days = table.where("band = 'a'").select("basin", "date", "x")
    got = {(r.band, r.date): r.pred for r in models.predict_days(table, chosen, days).collect()}
    con = duckdb.connect()
    s, d = table.toPandas(), days.toPandas()
    s["v"] = [x[0] if b == "a" else x[2] for b, x in zip(s["band"], s["x"], strict=True)]
    d["v0"], d["v2"] = [x[0] for x in d["x"]], [x[2] for x in d["x"]]
    s, d = s[["band", "y", "v"]], d[["date", "v0", "v2"]]
    rows = con.sql(
        "WITH r AS (SELECT band, y, v FROM s WHERE v IS NOT NULL AND NOT isnan(v) UNION ALL SELECT DISTINCT band, 0, 0 FROM s), f AS (SELECT band, regr_intercept(y, v) AS a, regr_slope(y, v) AS b FROM r GROUP BY band)"
        " SELECT band, date, a + b * CASE band WHEN 'a' THEN v0 ELSE v2 END FROM f CROSS JOIN d"
    ).fetchall()
    assert len(rows) == len(got)
    for band, date, p in rows:
        mine = got[band, getattr(date, "date", lambda d=date: d)()]
        assert (mine is None) == (p is None or np.isnan(p)) and (mine is None or np.isclose(mine, max(p, 0)))


def test_stored_models_train_only_what_is_new(spark, tmp_path, monkeypatch):
    table = made(spark)
    asks = spark.createDataFrame([(1, b, a, u, None, None) for b in "ab" for a, u in (("0,1", [0, 1]), ("2", [2]))], "basin int, band string, ask string, use array<int>, before int, without int")
    trained = []
    monkeypatch.setattr(models, "train", lambda t, by, most, asks, f=models.train: trained.append(asks.count()) or f(t, by, most, asks))
    path = f"{tmp_path}/models"
    first = models.stored_models(table, asks.where("ask = '2'"), path)
    assert first.count() == 2 and trained == [2]
    before = sorted(map(str, first.collect()))
    both = models.stored_models(table, asks, path)
    assert both.count() == 4 and trained == [2, 2]
    again = models.stored_models(table, asks, path)
    assert trained == [2, 2] and again.count() == 4 and spark.read.parquet(path).count() == 4
    assert sorted(map(str, again.where("ask = '2'").collect())) == before
    changed = table.withColumn("y", F.when(F.col("band") == "a", F.col("y") + 1).otherwise(F.col("y")))
    assert models.stored_models(changed, asks, path).count() == 4 and trained == [2, 2, 2]
    assert models.stored_models(table, asks.where("false"), f"{tmp_path}/other").count() == 0


# Whole queries


def test_selection_queries_whole(spark):
    table, _ = queries.survey(spark, SF)
    data = groups_of(table, ("basin", "band"))
    want = {k: plain.loyo(*v) for k, v in data.items()}
    out = QUERIES["m5_m7_loyo_selection"](spark, SF).collect()
    assert len(out) == sum(len(v[0]) for v in data.values())
    at = {(*k, d): (p, want[k][1][d.year], y) for k, v in data.items() for d, p, y in zip(v[0], want[k][0], v[2], strict=True)}
    for r in out:
        p, features, y = at[r.basin, r.band, r.date]
        assert list(r.features) == features and np.isclose(r.pred, p) and r.y == y and r.fold == r.date.year
    counts = Counter((*k, f) for k, (_, own) in want.items() for fs in own.values() for f in fs)
    assert {(r.basin, r.band, r.feature): r.n_folds for r in QUERIES["a29_fold_stations"](spark, SF).collect()} == counts
    best = QUERIES["m8_m9_best_subset"](spark, SF).collect()
    assert len(best) == 2 * len(data)
    for r in best:
        _, x, y = data[r.basin, r.band]
        if r.rule == "subsets":
            ties, top = plain.best_subset(x, y, want[r.basin, r.band][1])
            assert list(r.features) in ties and np.isclose(r.score, top)
        else:
            order = sorted({f for b, n, f in counts if (b, n) == (r.basin, r.band)}, key=lambda f: (-counts[r.basin, r.band, f], f))
            chosen, score = [], -np.inf
            for f in order:
                s = plain.loo_score(np.nan_to_num(x)[:, [*chosen, f]], y)
                if s > score + 1e-12:
                    chosen, score = [*chosen, f], s
            assert list(r.features) == chosen and np.isclose(r.score, score)


def test_specs_whole(spark):
    """Every spec's choice, validation and all its daily predictions."""
    by = ("basin", "band", "mode", "stack", "season")
    table, days = queries.spec_table(spark, SF)
    data = groups_of(table.select(*by, "date", "y", "x"), by)
    tests = {(r.basin, r["mode"], r.stack, r.date): r.x for r in days.collect()}
    out = QUERIES["m10_m12_specs_trained"](spark, SF).toPandas()
    assert len(out) == sum(sum(k[:1] == g[:1] and k[1:3] == g[2:4] for k in tests) for g in data)
    for key, own in out.groupby(list(by)):
        dates, x, y = data[key]
        row = own.iloc[0]
        check_training(row, dates, x, y)
        b = plain.final_fit(x, y, list(row.features))
        for date, mm in zip(own["date"], own["mm"], strict=True):
            v = [tests[key[0], key[2], key[3], date][i] for i in row.features]
            if None in v:
                assert np.isnan(mm)
            else:
                assert np.isclose(mm, max(0.0, b[0] + np.dot(b[1:], v)), rtol=1e-6, atol=1e-4)


def test_sets_served_whole(spark):
    table, _ = queries.survey(spark, SF)
    data = groups_of(table, ("basin", "band"))
    ids = {r.basin: list(r.stations) for r in table.collect()}
    obs = {(r.basin, r.date, r.station): r.value for r in views.obs(spark, SF).collect()}
    calendar = {(r.basin, r.date) for r in daily_calendar(views.obs(spark, SF)).collect()}
    out = QUERIES["m11_sets_served"](spark, SF).collect()
    assert len(out) == 2 * len(calendar) * len({b for _, b in data}) == len({(r.basin, r.band, r["mode"], r.date) for r in out})
    known, fits = {}, {}
    for r in out:
        use = [s for s in ids[r.basin] if obs.get((r.basin, r.date, s), 0) > 30 and (r["mode"] == "impute" or s % 5 < 3)]
        if not use:
            assert r.pred is None
            continue
        key = (r.basin, r.band, tuple(use))
        dates, x, y = data[key[:2]]
        if key not in known:
            check_key = [ids[r.basin].index(s) for s in use]
            _, features = plain.loyo(dates, x, y, check_key)
            ties, _ = plain.best_subset(x, y, features)
            assert list(r.features) in ties
            known[key], fits[key] = list(r.features), plain.final_fit(x, y, list(r.features))
        assert list(r.features) == known[key]
        v = [obs[r.basin, r.date, ids[r.basin][i]] for i in r.features]
        assert np.isclose(r.pred, max(0.0, fits[key][0] + np.dot(fits[key][1:], v)))
    assert {b for b, *_ in known} == set(ids)


def test_back_tests_whole(spark):
    table, _ = queries.survey(spark, SF)
    data = groups_of(table, ("basin", "band"))
    ids = {r.basin: list(r.stations) for r in table.collect()}
    obs = {(r.basin, r.date, r.station): r.value for r in views.obs(spark, SF).collect()}
    calendar = {(r.basin, r.date) for r in daily_calendar(views.obs(spark, SF)).collect()}
    out = QUERIES["m12_m15_predict_days"](spark, SF).toPandas()
    first = {k: min(map(water_year, v[0])) for k, v in data.items()}
    assert len(out) == sum(water_year(d) > first[k] for k in data for b, d in calendar if b == k[0])
    assert out["test_wy"].max() == max(water_year(d) for _, d in calendar)
    for (basin, band, year), own in out.groupby(["basin", "band", "test_wy"]):
        dates, x, y = data[basin, band]
        ok = np.array([water_year(d) < year for d in dates])
        row = own.iloc[0]
        if len({d.year for d in dates if water_year(d) < year}) == 1:
            assert own["mm"].isna().all() and year == first[basin, band] + 1
            continue
        check_training(row, [d for d in dates if water_year(d) < year], x[ok], y[ok])
        b = plain.final_fit(x[ok], y[ok], list(row.features))
        for date, mm in zip(own["date"], own["mm"], strict=True):
            v = [obs.get((basin, date, ids[basin][i])) for i in row.features]
            assert np.isnan(mm) if None in v else np.isclose(mm, max(0.0, b[0] + np.dot(b[1:], v)))
