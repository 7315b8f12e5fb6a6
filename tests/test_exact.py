"""Exact medians, polygons as a table, commits with a checklist, file scans: edges against plain versions; whole seasonal QA against numpy."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldspark.operators import aggregates, joins
from fieldspark.operators.calendars import daily_calendar
from fieldspark.plans import QUERIES
from fieldspark.plans.models import with_cells
from fieldspark.sources import io

D = dt.date
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("bins", "few"), [(4096, 100_000), (8, 3), (2, 1)])
def test_medians_by_histograms(spark, bins, few):
    rnd = random.Random(bins)
    groups = {
        "uniform": [rnd.uniform(-5, 5) for _ in range(401)],
        "even": [rnd.gauss(0, 1) for _ in range(400)],
        "ties": [float(rnd.choice([1, 2, 2, 3])) for _ in range(200)],
        "steep": [10.0 ** rnd.uniform(-12, 12) for _ in range(151)],
        "wide": [-1.7e308, 1.7e308, 1.0, 2.0],
        "one": [3.5],
        "two": [1.0, 2.0],
        "nulls": [None, None],
        "nan": [float("nan"), 1.0, float("nan")],
        "zeros": [-0.0, 0.0, 0.0],
        None: [7.0, 8.0, None],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double").repartition(5)
    want = {r.g: r.m for r in df.where("v IS NOT NULL").groupBy("g").agg(F.median("v").alias("m")).collect()}
    got = {r.g: r.median for r in aggregates.exact_medians(df, ["g"], "v", bins=bins, few=few).collect()}
    assert set(got) == set(want)
    assert all(got[g] == want[g] or np.isnan(got[g]) and np.isnan(want[g]) for g in want)
    whole = aggregates.exact_medians(df.where("g IN ('uniform', 'ties')"), [], "v", "m", bins, few).first()
    assert whole.m == np.median(groups["uniform"] + groups["ties"])
    assert aggregates.exact_medians(df.where("false"), ["g"], "v").count() == 0


def test_metrics_of_large_groups_are_the_same(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(g, rnd.uniform(0, 99), rnd.uniform(0, 99)) for g in ("a", None) for _ in range(60)], "g string, y double, p double")
    rows = lambda large: sorted(map(str, aggregates.metrics(df, ["g"], "y", "p", large=large).collect()))
    assert rows(True) == rows(False)
    assert aggregates.bias_factor(spark.createDataFrame([(None,)], "ratio double")).first().factor is None


def test_areas_share_no_point(spark):
    """A chessboard of squares with a hole: every point on a grid, corners and edges too, is in exactly one area or in the hole."""
    squares = [(f"{i}{j}", 0, k, i + dx, j + dy) for i in range(3) for j in range(3) for k, (dx, dy) in enumerate([(0, 0), (1, 0), (1, 1), (0, 1)])]
    hole = [("11", 1, k, 1 + x, 1 + y) for k, (x, y) in enumerate([(0.25, 0.25), (0.25, 0.75), (0.75, 0.75), (0.75, 0.25)])]
    corners = spark.createDataFrame([(a, r, s, float(x), float(y)) for a, r, s, x, y in squares + hole], "area string, ring int, seq int, x double, y double")
    points = spark.createDataFrame([(i / 8, j / 8) for i in range(-4, 30) for j in range(-4, 30)], "lon double, lat double")
    for height in (0.3, 1.0, 50.0):
        got = joins.areas_of_points(points, corners, height).collect()
        assert len({(r.lon, r.lat) for r in got}) == len(got)
        want = {(x / 8, y / 8): f"{x // 8}{y // 8}" for x in range(24) for y in range(24) if not (10 <= x < 14 and 10 <= y < 14)}
        assert {(r.lon, r.lat): r.area for r in got} == want
    assert joins.areas_of_points(points, corners.where("false"), 1.0).count() == 0


def test_commits_replace_and_log(spark, tmp_path):
    path, log = f"{tmp_path}/t", f"{tmp_path}/log"
    rows = [(1, D(2020, 1, 1), 1.0), (2, D(2020, 1, 1), 2.0), (1, D(2020, 1, 2), 3.0), (1, D(2020, 2, 1), None), (1, None, 9.0)]
    df = spark.createDataFrame(rows, "basin int, date date, v double")
    read = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert read(io.commit_dates(df, path, log)) == sorted(rows[:4], key=str)
    state = lambda: {r.date: (r.n_rows, r.run) for r in io.checklist(spark, log).collect()}
    assert state() == {D(2020, 1, 1): (2, 1), D(2020, 1, 2): (1, 1), D(2020, 2, 1): (1, 1)}
    assert read(io.commit_dates(df.repartition(3), path, log)) == sorted(rows[:4], key=str) and len(spark.read.parquet(log).collect()) == 3
    fixed = spark.createDataFrame([(1, D(2020, 1, 1), 5.0), (1, D(2020, 1, 3), 4.0)], df.schema)
    want = [(1, D(2020, 1, 1), 5.0), (1, D(2020, 1, 2), 3.0), (1, D(2020, 1, 3), 4.0), (1, D(2020, 2, 1), None)]
    assert read(io.commit_dates(fixed, path, log)) == sorted(want, key=str)
    assert state() == {D(2020, 1, 1): (1, 2), D(2020, 1, 2): (1, 1), D(2020, 1, 3): (1, 2), D(2020, 2, 1): (1, 1)}
    spark.createDataFrame([(D(2020, 1, 3), 1, "lost", 3)], io.CHECKLIST).write.mode("append").parquet(log)  # data written, entry another: broken off
    assert read(io.commit_dates(fixed, path, log)) == sorted(want, key=str) and state()[D(2020, 1, 3)][1] == 4
    assert io.commit_dates(df.where("false"), f"{tmp_path}/none", f"{tmp_path}/none-log").count() == 0


def test_last_rows_are_the_files_own(spark, tmp_path):
    for name, n in (("a", 5), ("b", 1), ("c", 2)):
        spark.createDataFrame([(name, (i * 7) % 5) for i in range(n)], "name string, v int").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    rows = io.scan_files(spark.read.parquet(*[f"{tmp_path}/{n}" for n in "abc"]))
    assert sorted((r.name, r.v) for r in io.last_of_files(rows).collect()) == [("a", 1), ("a", 3), ("b", 0), ("c", 0), ("c", 2)]


def test_seasonal_qa_whole(spark):
    """Every row of the seasonal method: two fits a station in numpy of which the trend gate takes one, the interval and the reasons."""
    out = {(r.basin, r.station, r.date): r for r in QUERIES["q3_model_seasonal"](spark, SF).collect()}
    rows = sorted(daily_calendar(with_cells(spark, SF)).collect(), key=lambda r: (r.basin, r.station, r.date))
    split, used = D(2000, 10, 1), 0
    stations = {}
    for r in rows:
        stations.setdefault((r.basin, r.station), []).append(r)
    for own in stations.values():
        angle = lambda d: 2 * np.pi * ((d - D(d.year - (d.month < 10), 10, 1)).days + 1) / 365.25
        x = lambda r, wide: [1, r.g1, r.g2, r.g3, *([np.sin(angle(r.date)), np.cos(angle(r.date))] if wide else [])]
        hist = [r for r in own if r.date < split and r.value is not None and r.g1 is not None]
        test = [r for r in own if r.date >= split]
        fits = {}
        for wide in (False, True):
            if len(hist) >= 60:
                a, y = np.array([x(r, wide) for r in hist], float), np.array([r.value for r in hist])
                b = np.linalg.lstsq(a, y, rcond=None)[0]
                fits[wide] = (b, np.sqrt(((y - a @ b) ** 2).sum() / (len(y) - a.shape[1])), np.linalg.pinv(a.T @ a))
        for r in test:
            got = out.pop((r.basin, r.station, r.date))
            if r.g1 is None or not fits:
                assert got.pred is None and got.reason_code == ("MISSING" if r.value is None else "SKIPPED")
                continue
            options = []
            for wide in (False, True):
                b, sigma, inv = fits[wide]
                v = np.array(x(r, wide), float)
                options.append((max(0.0, float(v @ b)), float(sigma * np.sqrt(1 + v @ inv @ v))))
            near = [k for k, (p, se) in enumerate(options) if np.isclose(got.pred, p, atol=2e-3) and np.isclose(got.se, se, atol=2e-3)]
            assert near
            used += 1 in near
            p, se = options[near[-1]]
            limit = max(2 * se * 1.2, 25, 0.05 * max(abs(p), 1))
            want = "MISSING" if r.value is None else "PHYSICAL" if r.value < 0 or r.value > 3000 else "SKIPPED" if p < 10 else "PRED_RESID" if abs(r.value - p) > limit else "OK"
            assert got.reason_code == want or abs(abs(r.value - p) - limit) < 1e-2
    assert not out and used > 100
