"""Queries of sequences, joins, peers, quality control, aggregates and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.functions import units as U
from fieldspark.operators import aggregates as A
from fieldspark.operators import calendars as K
from fieldspark.operators import joins as J
from fieldspark.operators import peers as P
from fieldspark.operators import qa as Q
from fieldspark.operators import sequences as W
from fieldspark.plans.catalog import query
from fieldspark.sources import views as V
from fieldspark.sources.tables import written

FULL = ("obs", "days", "full_obs")
SPLIT = "2000-10-01"


def full(spark: SparkSession, sf: str) -> DataFrame:
    return K.daily_calendar(V.obs(spark, sf))


def cell_band(spark: SparkSession, sf: str) -> DataFrame:
    own = U.with_band(V.cells(spark, sf), "elev", V.bands(spark)).select("y", "x", F.explode(F.array("band", F.lit("total"))).alias("band"))
    return own


@query(
    "w1_w2_steps",
    " SELECT basin, station, date, value - lag(value) OVER w AS delta, CASE WHEN row_number() OVER w = 1 THEN value - value ELSE value - lag(value) OVER w END AS today, coalesce(lag(value IS NULL) OVER w AND value IS NOT NULL, false) AS appeared FROM full_obs WINDOW w AS (PARTITION BY basin, station ORDER BY date)",
    FULL,
)
def _(spark, sf):
    v = F.col("value")
    return full(spark, sf).select("basin", "station", "date", W.row_difference(v).alias("delta"), W.row_difference(v, first_is_zero=True).alias("today"), W.null_to_value(v).alias("appeared"))


FLAGGED = ", f AS (SELECT basin, station, date, CAST(coalesce(value > 60, false) AS INT) AS flag FROM full_obs)"


@query(
    "w3_runs",
    FLAGGED
    + ", s AS (SELECT *, CAST(flag <> lag(flag, 1, 0) OVER w AS INT) AS st FROM f WINDOW w AS (PARTITION BY basin, station ORDER BY date)), r AS (SELECT *, sum(st) OVER (PARTITION BY basin, station ORDER BY date) AS run FROM s) SELECT basin, station, date, flag, CAST(flag = 1 AND count(*) OVER (PARTITION BY basin, station, run) >= 3 AS INT) AS persistent FROM r",
    FULL,
)
def _(spark, sf):
    f = full(spark, sf).select("basin", "station", "date", F.coalesce(F.col("value") > 60, F.lit(False)).cast("int").alias("flag"))
    return W.long_runs(f, "flag", 3)


@query(
    "w4_widen",
    FLAGGED
    + ", n AS (SELECT *, lag(flag, 1, 0) OVER w AS p1, lag(flag, 2, 0) OVER w AS p2, lead(flag, 1, 0) OVER w AS n1, lead(flag, 2, 0) OVER w AS n2 FROM f WINDOW w AS (PARTITION BY basin, station ORDER BY date)) SELECT basin, station, date, greatest(flag, CAST(p1 = 1 AND p2 = 0 AND flag = 0 AS INT), CAST(n1 = 1 AND n2 = 0 AND flag = 0 AS INT)) AS wide FROM n",
    FULL,
)
def _(spark, sf):
    f = full(spark, sf).select("basin", "station", "date", F.coalesce(F.col("value") > 60, F.lit(False)).cast("int").alias("flag"))
    return f.select("basin", "station", "date", W.widen_lonely(F.col("flag")).alias("wide"))


@query(
    "w8_rising_gate",
    ", d AS (SELECT *, value - lag(value) OVER w AS d1, value * 2 - lag(value * 2) OVER w AS d2 FROM full_obs WINDOW w AS (PARTITION BY basin, station ORDER BY date)), t AS (SELECT *, coalesce(sum(d1) OVER v, 0) + coalesce(sum(d2) OVER v, 0) AS t, count(d1) OVER v + count(d2) OVER v AS n FROM d WINDOW v AS (PARTITION BY basin, station ORDER BY date ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)) SELECT basin, station, date, CASE WHEN n = 0 THEN true ELSE t / n > 2.0 END AS gate FROM t",
    FULL,
)
def _(spark, sf):
    rows = full(spark, sf).withColumn("twice", F.col("value") * 2)
    return W.with_gate(rows, ["value", "twice"], 3, 2.0).select("basin", "station", "date", "gate")


@query(
    "w10_l3_one_file",
    "SELECT o_orderpriority, o_orderstatus, o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS ord FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_custkey % 7 = 0 DESC, o_orderkey DESC) = 1 ORDER BY o_orderpriority, ord",
)
def _(spark, sf):
    rows = V.table(spark, sf, "orders")
    one = W.one_per_group(rows, ["o_orderpriority", "o_orderstatus"], [F.desc(F.col("o_custkey") % 7 == 0), F.desc("o_orderkey")])
    return one.select("o_orderpriority", "o_orderstatus", "o_orderkey", W.season_order(F.col("o_orderstatus"), ("O", "F", "P")).cast("int").alias("ord")).orderBy("o_orderpriority", "ord")


@query("l1_l4_top_k", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 5")
def _(spark, sf):
    rows = V.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return W.top_k(rows, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 5)


@query("l2_first_best", "SELECT p_brand, p_name FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) = 1")
def _(spark, sf):
    return W.first_best(V.table(spark, sf, "part"), ["p_brand"], "p_name", "p_size", "p_partkey")


# Joins


@query("j2_survey_with_stations", " SELECT l.basin, l.date, round(l.value, 2) AS survey, o.station, o.value FROM labels l JOIN obs o USING (basin, date) WHERE l.band = 'total'", ("obs", "labels"))
def _(spark, sf):
    return J.survey_with_stations(V.labels(spark, sf), V.obs(spark, sf)).withColumn("survey", F.round("survey", 2))


#: All station ids of the example network, the one that gives the dates first.
STATIONS = [1, 0, *range(2, 25)]


@query("j3_wide_table", " SELECT b.date, " + ", ".join(f'max(value) FILTER (WHERE station = {s}) AS "{s}"' for s in STATIONS) + " FROM (SELECT DISTINCT date FROM obs WHERE station = 1) b JOIN obs USING (date) GROUP BY b.date", ("obs",))
def _(spark, sf):
    return J.wide_table(V.obs(spark, sf), STATIONS, outer=False)


def near_sql(tie: str) -> str:
    order = f"abs(date_diff('day', l.date, o.date)), {'-' if tie == 'later' else ''}date_diff('day', l.date, o.date)"
    return f", l AS (SELECT DISTINCT basin, station, date FROM (SELECT DISTINCT basin, date FROM labels) JOIN (SELECT DISTINCT basin, station FROM obs) USING (basin)), s AS (SELECT * FROM obs WHERE day(date) IN (3, 7, 29) AND NOT (year(date) = 1998 AND station % 2 = 0)) SELECT l.basin, l.station, l.date, o.date AS near_date, o.value FROM l JOIN s o USING (basin, station) QUALIFY row_number() OVER (PARTITION BY l.basin, l.station, l.date ORDER BY {order}) = 1"


def near(spark, sf, tie):
    obs = V.obs(spark, sf)
    left = V.labels(spark, sf).select("basin", "date").distinct().join(obs.select("basin", "station").distinct(), "basin")
    right = obs.where(F.day("date").isin(3, 7, 29) & ~((F.year("date") == 1998) & (F.col("station") % 2 == 0)))
    return J.nearest(left, right, ["basin", "station"], tie=tie)


@query("j4_nearest_later", near_sql("later"), ("obs", "labels"))
def _(spark, sf):
    return near(spark, sf, "later")


@query("j5_nearest_earlier", near_sql("earlier"), ("obs", "labels"))
def _(spark, sf):
    return near(spark, sf, "earlier")


@query(
    "j5_as_of",
    ", l AS (SELECT DISTINCT basin, station, date FROM (SELECT DISTINCT basin, date FROM labels) JOIN (SELECT DISTINCT basin, station FROM obs) USING (basin)) SELECT l.basin, l.station, l.date, b.date AS back_date, f.date AS next_date FROM l ASOF LEFT JOIN obs b ON l.basin = b.basin AND l.station = b.station AND l.date >= b.date ASOF LEFT JOIN obs f ON l.basin = f.basin AND l.station = f.station AND l.date <= f.date",
    ("obs", "labels"),
)
def _(spark, sf):
    obs = V.obs(spark, sf)
    left = V.labels(spark, sf).select("basin", "date").distinct().join(obs.select("basin", "station").distinct(), "basin")
    keys = ["basin", "station"]
    back = J.as_of(left, obs, keys).withColumnRenamed("near_date", "back_date").drop("value")
    return back.join(J.as_of(left, obs, keys, direction="forward").withColumnRenamed("near_date", "next_date").drop("value"), [*keys, "date"])


@query(
    "j6_season_part",
    ", t AS (SELECT DISTINCT CAST(y AS INT) AS year, b AS basin, make_date(CAST(y AS INT), 3 + CAST(b % 3 AS INT), 15) AS threshold FROM range(1995, 2000) r(y), range(0, 4) s(b)) SELECT o.basin, station, o.date, value, o.date < threshold AS accum FROM obs o JOIN t ON t.year = year(o.date) AND t.basin = o.basin",
    ("obs",),
)
def _(spark, sf):
    t = spark.range(1995, 2000).select(F.col("id").cast("int").alias("year")).crossJoin(spark.range(4).select(F.col("id").cast("int").alias("basin")))
    t = t.withColumn("threshold", F.make_date("year", (3 + F.col("basin") % 3).cast("int"), F.lit(15)))
    t = t.unionByName(t.where("year = 1998"))
    obs = V.obs(spark, sf).withColumn("year", F.year("date"))
    parts = [J.season_part(obs, t, p, ("year", "basin")).withColumn("accum", F.lit(p == "accum")) for p in ("accum", "melt")]
    return parts[0].unionByName(parts[1]).select("basin", "station", "date", "value", "accum")


CLEANED = ", clean AS (SELECT basin, station, date, CASE WHEN value > 80 THEN NULL WHEN station % 5 = 0 THEN value + 1 ELSE value END AS value FROM obs WHERE date < DATE '2001-01-01')"


def cleaned(spark, sf):
    v = F.when(F.col("value") <= 80, F.when(F.col("station") % 5 == 0, F.col("value") + 1).otherwise(F.col("value")))
    return V.obs(spark, sf).where("date < '2001-01-01'").withColumn("value", v)


@query("j7_correct", CLEANED + " SELECT basin, station, date, c.basin IS NOT NULL AND o.value IS DISTINCT FROM c.value AS changed, CASE WHEN c.basin IS NOT NULL THEN c.value ELSE o.value END AS value FROM (SELECT *, basin AS b FROM obs) o LEFT JOIN clean c USING (basin, station, date)", ("obs",))
def _(spark, sf):
    return J.correct(V.obs(spark, sf), cleaned(spark, sf)).select("basin", "station", "date", "changed", "value")


@query("j8_overwrite", CLEANED + " SELECT basin, station, date, coalesce(c.value, o.value) AS value FROM obs o LEFT JOIN clean c USING (basin, station, date)", ("obs",))
def _(spark, sf):
    return J.overwrite(V.obs(spark, sf), cleaned(spark, sf)).select("basin", "station", "date", "value")


@query("j10_semi_anti", " SELECT basin, count(*) FILTER (WHERE date IN (SELECT date FROM labels)) AS n_in, count(*) FILTER (WHERE date NOT IN (SELECT date FROM labels)) AS n_out FROM obs GROUP BY basin", ("obs", "labels"))
def _(spark, sf):
    obs, dates = V.obs(spark, sf), V.labels(spark, sf).select("date").distinct()
    a = obs.join(dates, "date", "left_semi").groupBy("basin").agg(F.count("*").alias("n_in"))
    return a.join(obs.join(dates, "date", "left_anti").groupBy("basin").agg(F.count("*").alias("n_out")), "basin")


PRODUCTS = ", products AS (SELECT CASE basin WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS name, date, band, value FROM labels WHERE basin < 3 AND NOT (basin = 1 AND year(date) < 1996))"


def products(spark, sf):
    name = F.when(F.col("basin") == 0, "a").when(F.col("basin") == 1, "b").otherwise("c")
    return V.labels(spark, sf).where("basin < 3 AND NOT (basin = 1 AND year(date) < 1996)").select(name.alias("name"), "date", "band", "value")


@query("j11_align_products", PRODUCTS + " SELECT date, round(max(value) FILTER (WHERE name = 'a'), 2) AS a, round(max(value) FILTER (WHERE name = 'b'), 2) AS b, round(max(value) FILTER (WHERE name = 'c'), 2) AS c FROM products WHERE band = 'total' GROUP BY date", ("labels",))
def _(spark, sf):
    return J.align_products(products(spark, sf).where("band = 'total'"), ["a", "b", "c"]).select("date", *[F.round(c, 2).alias(c) for c in "abc"])


@query("j12_j14_mask", " SELECT date, y, x, greatest(value - 20, 0.0) AS value FROM grid WHERE (y, x) IN (SELECT (y, x) FROM cell_band WHERE band = '4k-7k')", ("grid", "cells", "bands", "cell_band"))
def _(spark, sf):
    grid = V.grid(spark, sf).withColumn("value", F.col("value") - 20)
    return J.in_mask(grid, cell_band(spark, sf).where("band = '4k-7k'")).select("date", "y", "x", "value")


@query("j13_grid_at_stations", " SELECT s_nationkey AS station, date, max(value) FILTER (WHERE x = 1) AS best, max(value) FILTER (WHERE x = 2) AS second, max(value) FILTER (WHERE x = 3 AND s_nationkey % 2 = 0) AS third FROM grid JOIN (SELECT s_nationkey, min(s_suppkey) AS y FROM supplier GROUP BY 1) s USING (y) WHERE x <= 2 OR (x = 3 AND s_nationkey % 2 = 0) GROUP BY 1, 2", ("grid",))
def _(spark, sf):
    own = V.table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("station")).agg(F.min("s_suppkey").alias("y"))
    ranks = F.explode(F.array(*[F.struct(F.lit(r).alias("rank"), F.lit(i + 1).cast("long").alias("x")) for i, r in enumerate(("best", "second", "third"))])).alias("r")
    cells = own.select("station", "y", ranks).select("station", F.when((F.col("r.rank") != "third") | (F.col("station") % 2 == 0), F.col("y")).alias("y"), "r.x", "r.rank")
    return J.grid_at_stations(V.grid(spark, sf), cells)


@query("j15_polygon", "SELECT s_suppkey, s_acctbal AS lon, CAST(s_nationkey AS DOUBLE) + 0.5 AS lat FROM supplier WHERE s_acctbal BETWEEN 0 AND 8000 AND s_nationkey + 0.5 BETWEEN 2 AND 18 AND (s_acctbal - 0) / 8000 + (s_nationkey + 0.5 - 2) / 16 < 1")
def _(spark, sf):
    points = V.table(spark, sf, "supplier").select("s_suppkey", F.col("s_acctbal").alias("lon"), (F.col("s_nationkey").cast("double") + 0.5).alias("lat"))
    return J.in_polygon(points, [(0.0, 2.0), (8000.0, 2.0), (0.0, 18.0)])


#: An arrow-shaped ring a region, and a square hole in each (offsets from the region's corner).
ARROW = [(0.0, 0.0), (2500.0, 4.0), (5000.0, 0.0), (2500.0, 12.0)]
HOLE = [(2000.0, 5.0), (3000.0, 5.0), (3000.0, 7.0), (2000.0, 7.0)]


@query(
    "j15_areas",
    "WITH c AS (SELECT r_regionkey AS area, ring, seq, x + 1500 * r_regionkey AS x, y + 3 * r_regionkey AS y FROM region, (VALUES "
    + ", ".join(f"({ring}, {i}, {x}::DOUBLE, {y}::DOUBLE)" for ring, own in enumerate((ARROW, HOLE)) for i, (x, y) in enumerate(own))
    + ") v(ring, seq, x, y)), e AS (SELECT area, x AS x1, y AS y1, coalesce(lead(x) OVER w, first(x) OVER w) AS x2, coalesce(lead(y) OVER w, first(y) OVER w) AS y2 FROM c WINDOW w AS (PARTITION BY area, ring ORDER BY seq))"
    " SELECT c_custkey, area FROM (SELECT c_custkey, c_acctbal AS lon, CAST(c_nationkey AS DOUBLE) AS lat FROM customer) JOIN e ON (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1",
)
def _(spark, sf):
    rings = F.explode(F.array(*[F.struct(F.lit(ring).alias("ring"), F.lit(i).alias("seq"), F.lit(x).alias("dx"), F.lit(y).alias("dy")) for ring, own in enumerate((ARROW, HOLE)) for i, (x, y) in enumerate(own)])).alias("c")
    corners = V.table(spark, sf, "region").select(F.col("r_regionkey").alias("area"), rings).select("area", "c.ring", "c.seq", (F.col("c.dx") + 1500 * F.col("area")).alias("x"), (F.col("c.dy") + 3 * F.col("area")).alias("y"))
    points = V.table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("lon"), F.col("c_nationkey").cast("double").alias("lat"))
    return J.areas_of_points(points, corners, 2.0).select("c_custkey", "area")


@query(
    "j16_daily_status",
    CLEANED + ", st AS (SELECT o.basin, o.station, o.date, CASE WHEN o.value IS NULL THEN 'missing' WHEN o.station = 7 THEN 'excluded' WHEN c.value IS NULL THEN 'failed' ELSE 'usable' END AS status FROM full_obs o LEFT JOIN clean c ON c.basin = o.basin AND c.station = o.station AND c.date = o.date) SELECT basin, date, coalesce(list_sort(list(DISTINCT station) FILTER (WHERE status = 'usable')), []) AS usable, count(*) FILTER (WHERE status = 'failed') AS failed FROM st GROUP BY ALL",
    FULL,
)
def _(spark, sf):
    days = full(spark, sf)
    status = J.daily_status(days, cleaned(spark, sf), days.where("station = 7"))
    failed = status.groupBy("basin", "date").agg(F.count_if(F.col("status") == "failed").alias("failed"))
    return J.usable_sets(status).join(failed, ["basin", "date"])


@query("j17_observed_and_predicted", CLEANED + " SELECT basin, station, date, o.value AS observed, c.value AS predicted FROM obs o LEFT JOIN clean c USING (basin, station, date)", ("obs",))
def _(spark, sf):
    return J.observed_and_predicted(V.obs(spark, sf), cleaned(spark, sf))


# Peers

PAIRS = ", h AS (SELECT *, value - lag(value) OVER (PARTITION BY basin, station ORDER BY date) AS d FROM full_obs WHERE date < DATE '2000-10-01'), pr AS (SELECT a.basin, a.station, b.station AS peer, count(*) AS n, corr(a.d, b.d) AS r, regr_slope(a.d, b.d) AS slope, regr_intercept(a.d, b.d) AS intercept FROM h a JOIN h b ON a.basin = b.basin AND a.date = b.date AND a.station <> b.station WHERE a.d IS NOT NULL AND b.d IS NOT NULL GROUP BY ALL HAVING count(*) >= 200), ranked AS (SELECT *, r * r AS score, row_number() OVER (PARTITION BY basin, station ORDER BY round(r * r, 12) DESC, peer DESC) AS rk FROM pr)"


def history(spark, sf):
    return full(spark, sf).where(F.col("date") < SPLIT)


def test_days(spark, sf):
    return full(spark, sf).where(F.col("date") >= SPLIT)


def ranking(hist):
    return written(P.ranked_peers(P.pair_stats(hist.withColumn("d", W.row_difference(F.col("value"))), "d")), "ranking")


@query("j9_a11_a12_pairs", PAIRS + " SELECT basin, station, peer, n, round(r, 9) AS r, round(slope, 9) AS slope, round(intercept, 9) AS intercept FROM pr", FULL)
def _(spark, sf):
    stats = P.pair_stats(history(spark, sf).withColumn("d", W.row_difference(F.col("value"))), "d")
    return stats.select("basin", "station", "peer", "n", *[F.round(c, 9).alias(c) for c in ("r", "slope", "intercept")])


@query(
    "j9_wide_load",
    " SELECT a.basin, a.station, b.station AS peer, count(*) AS n, round(corr(a.value, b.value), 8) AS r, round(regr_slope(a.value, b.value), 8) AS slope, round(regr_intercept(a.value, b.value), 6) AS intercept FROM obs_wide_load a JOIN obs_wide_load b ON a.basin = b.basin AND a.date = b.date AND a.station <> b.station GROUP BY ALL HAVING count(*) >= 10 AND var_pop(a.value) > 0 AND var_pop(b.value) > 0",
    ("obs_wide_load",),
)
def _(spark, sf):
    stats = P.pair_stats(V.obs_wide_load(spark, sf), "value", 10)
    return stats.select("basin", "station", "peer", "n", F.round("r", 8).alias("r"), F.round("slope", 8).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query("w5_ranked_peers", PAIRS + " SELECT basin, station, peer, CAST(rk AS INTEGER) AS rk FROM ranked", FULL)
def _(spark, sf):
    return ranking(history(spark, sf)).select("basin", "station", "peer", "rk")


@query("a9_a10_spread", ", d AS (SELECT *, value - lag(value) OVER (PARTITION BY basin, station ORDER BY date) AS d FROM full_obs) SELECT basin, station, round(1.4826 * mad(d), 9) AS sigma, round(quantile_cont(d, 0.005), 9) AS lo, round(quantile_cont(d, 0.995), 9) AS hi FROM d WHERE d IS NOT NULL GROUP BY ALL", FULL)
def _(spark, sf):
    steps = full(spark, sf).withColumn("d", W.row_difference(F.col("value")))
    s = P.robust_sigma(steps, ["basin", "station"], "d", 5, True).select("basin", "station", F.round("sigma", 9).alias("sigma"))
    return s.join(P.quantile_bounds(steps, ["basin", "station"], "d").select("basin", "station", F.round("lo", 9).alias("lo"), F.round("hi", 9).alias("hi")), ["basin", "station"])


TODAY = ", t AS (SELECT * FROM full_obs WHERE date >= DATE '2000-10-01')"


@query("a16_w7_peer_median", PAIRS + TODAY + " SELECT t.basin, t.station, t.date, median(o.value) AS peer_median, list_sort(list(DISTINCT k.peer)) AS peer_set FROM t JOIN ranked k ON k.basin = t.basin AND k.station = t.station AND k.rk <= 3 JOIN t o ON o.basin = t.basin AND o.station = k.peer AND o.date = t.date AND o.value IS NOT NULL GROUP BY ALL", FULL)
def _(spark, sf):
    return P.peer_median(test_days(spark, sf), ranking(history(spark, sf)), 3)


@query("w7_available_peers", PAIRS + TODAY + " SELECT t.basin, t.station, t.date, k.peer, CAST(k.rk AS INTEGER) AS rk, o.value AS peer_value FROM t JOIN ranked k ON k.basin = t.basin AND k.station = t.station JOIN t o ON o.basin = t.basin AND o.station = k.peer AND o.date = t.date AND o.value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY t.basin, t.station, t.date ORDER BY k.rk) <= 2", FULL)
def _(spark, sf):
    out = P.peers_today(test_days(spark, sf), ranking(history(spark, sf)), 2, rank_first=False)
    return out.select("basin", "station", "date", "peer", "rk", "peer_value")


# Quality control

STATIC = (
    PAIRS
    + """, q AS (SELECT basin, station, quantile_cont(d, 0.05) AS lo, quantile_cont(d, 0.95) AS hi FROM h WHERE d IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
t AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN value - value ELSE value - lag(value) OVER w END AS delta, coalesce(lag(value IS NULL) OVER w AND value IS NOT NULL, false) AS appeared FROM full_obs WHERE date >= DATE '2000-10-01' WINDOW w AS (PARTITION BY basin, station ORDER BY date)),
pm AS (SELECT t.basin, t.station, t.date, median(o.value) AS m, list_sort(list(DISTINCT k.peer)) AS ps FROM t JOIN ranked k ON k.basin = t.basin AND k.station = t.station AND k.rk <= 5 JOIN t o ON o.basin = t.basin AND o.station = k.peer AND o.date = t.date AND o.value IS NOT NULL GROUP BY ALL),
sets AS (SELECT DISTINCT basin, station, ps FROM pm),
hm AS (SELECT s.basin, s.station, s.ps, o.date, median(o.value) AS m FROM (SELECT *, unnest(ps) AS peer FROM sets) s JOIN h o ON o.basin = s.basin AND o.station = s.peer AND o.value IS NOT NULL GROUP BY ALL),
sg AS (SELECT hm.basin, hm.station, hm.ps, CASE WHEN count(*) >= 5 AND mad(h.value - hm.m) > 0 THEN 1.4826 * mad(h.value - hm.m) END AS sigma FROM hm JOIN h ON h.basin = hm.basin AND h.station = hm.station AND h.date = hm.date AND h.value IS NOT NULL GROUP BY ALL),
static AS (SELECT t.basin, t.station, t.date, CASE WHEN value IS NULL THEN 'MISSING' WHEN value < 0 OR value > 90 THEN 'PHYSICAL' WHEN appeared THEN 'APPEARED' WHEN delta < lo * 1.0 OR delta > hi * 1.0 THEN 'DELTA'
  WHEN m IS NOT NULL AND sigma IS NOT NULL AND abs(value - m) > greatest(3 * sigma * 1.2, 25, 0.05 * greatest(abs(m), 1)) THEN 'PEER_RESID' WHEN m IS NULL OR sigma IS NULL THEN 'SKIPPED' ELSE 'OK' END AS reason_code
  FROM t LEFT JOIN q USING (basin, station) LEFT JOIN pm ON pm.basin = t.basin AND pm.station = t.station AND pm.date = t.date LEFT JOIN sg ON sg.basin = t.basin AND sg.station = t.station AND sg.ps = pm.ps)"""
)


def static_result(spark, sf):
    days = written(full(spark, sf), "qa-days")
    hist, test = days.where(F.col("date") < SPLIT), days.where(F.col("date") >= SPLIT)
    return Q.static_qa(hist, test, ranking(hist), gate=None, q_lo=0.05, q_hi=0.95, buffer=1.0, high=90.0)


@query("q1_static_qa", STATIC + " SELECT basin, station, date, reason_code, CAST(reason_code NOT IN ('OK', 'SKIPPED') AS INT) AS flag FROM static", FULL)
def _(spark, sf):
    return static_result(spark, sf).select("basin", "station", "date", "reason_code", "flag")


VOTING = (
    PAIRS
    + """, t AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN value - value ELSE value - lag(value) OVER w END AS delta FROM full_obs WHERE date >= DATE '2000-10-01' WINDOW w AS (PARTITION BY basin, station ORDER BY date)),
er AS (SELECT k.basin, k.station, k.peer, 1.4826 * mad(a.d - k.intercept - k.slope * b.d) AS sigma FROM ranked k JOIN h a ON a.basin = k.basin AND a.station = k.station AND a.d IS NOT NULL JOIN h b ON b.basin = k.basin AND b.station = k.peer AND b.date = a.date AND b.d IS NOT NULL GROUP BY ALL),
av AS (SELECT t.basin, t.station, t.date, t.delta, k.peer, k.score, k.intercept + k.slope * o.delta AS e, er.sigma FROM t JOIN ranked k ON k.basin = t.basin AND k.station = t.station JOIN t o ON o.basin = t.basin AND o.station = k.peer AND o.date = t.date AND o.delta IS NOT NULL
  JOIN er ON er.basin = k.basin AND er.station = k.station AND er.peer = k.peer QUALIFY row_number() OVER (PARTITION BY t.basin, t.station, t.date ORDER BY k.rk) <= 5),
vv AS (SELECT *, abs(delta - e) AS miss, abs(delta - e) <= greatest(3 * sigma * 1.2, 25, 0.05 * greatest(abs(e), 1)) AS ok, count(*) OVER (PARTITION BY basin, station, date) AS n, row_number() OVER (PARTITION BY basin, station, date ORDER BY abs(delta - e), peer) AS rn FROM av WHERE delta IS NOT NULL),
ta AS (SELECT basin, station, date, count(*) AS votes, sum(score * CAST(ok AS INT)) / sum(score) AS okf FROM vv WHERE rn <= n - greatest(0, least(floor(n * 0.2), n - 3)) GROUP BY ALL HAVING count(*) >= 3),
voting AS (SELECT t.basin, t.station, t.date, CASE WHEN value IS NULL THEN 'MISSING' WHEN value < 0 OR value > 90 THEN 'PHYSICAL' WHEN okf < 0.6 AND NOT coalesce(value < 20 AND value - delta < 20, false) THEN 'VOTING' WHEN okf IS NULL OR coalesce(value < 20 AND value - delta < 20, false) THEN 'SKIPPED' ELSE 'OK' END AS reason_code FROM t LEFT JOIN ta USING (basin, station, date))"""
)


def voting_result(spark, sf):
    days = written(full(spark, sf), "qa-days")
    hist, test = days.where(F.col("date") < SPLIT), days.where(F.col("date") >= SPLIT)
    return Q.voting_qa(hist, test, ranking(hist), gate=20.0, high=90.0, fitted=True)


@query("q2_voting_qa", VOTING + " SELECT basin, station, date, reason_code, CAST(reason_code NOT IN ('OK', 'SKIPPED') AS INT) AS flag FROM voting", FULL)
def _(spark, sf):
    return voting_result(spark, sf).select("basin", "station", "date", "reason_code", "flag")


METHODS = "('static', 'voting', 'model')"
FLAGS = ", fl AS (SELECT basin, station, date, m AS method, CAST(CASE m WHEN 'static' THEN value > 60 WHEN 'voting' THEN value > 55 AND station % 3 > 0 ELSE value % 2 = 0 END AS INT) AS flag FROM obs, (VALUES ('static'), ('voting'), ('model')) v(m) WHERE NOT (m = 'model' AND station % 4 = 0))"


def example_flags(spark, sf):
    v, s = F.col("value"), F.col("station")
    rows = V.obs(spark, sf).select("basin", "station", "date", "value", F.explode(F.array(*map(F.lit, ("static", "voting", "model")))).alias("method"))
    flag = F.when(F.col("method") == "static", v > 60).when(F.col("method") == "voting", (v > 55) & (s % 3 > 0)).otherwise(v % 2 == 0)
    return rows.where((F.col("method") != "model") | (s % 4 != 0)).withColumn("flag", flag.cast("int"))


@query("a14_majority", FLAGS + " SELECT basin, station, date, coalesce(max(flag) FILTER (WHERE method = 'static'), 0) AS static, coalesce(max(flag) FILTER (WHERE method = 'voting'), 0) AS voting, coalesce(max(flag) FILTER (WHERE method = 'model'), 0) AS model, CAST(coalesce(max(flag) FILTER (WHERE method = 'static'), 0) + coalesce(max(flag) FILTER (WHERE method = 'voting'), 0) + coalesce(max(flag) FILTER (WHERE method = 'model'), 0) >= 2 AS INT) AS majority FROM fl GROUP BY basin, station, date", ("obs",))
def _(spark, sf):
    return Q.majority(example_flags(spark, sf))


MASKED = (
    FLAGS
    + ", mj AS (SELECT basin, station, date, CAST(sum(flag) >= 2 AS INT) AS mj FROM fl GROUP BY ALL), c AS (SELECT f.*, coalesce(mj, 0) AS mj FROM full_obs f LEFT JOIN mj USING (basin, station, date)), st AS (SELECT *, CAST(mj <> lag(mj, 1, 0) OVER (PARTITION BY basin, station ORDER BY date) AS INT) AS s FROM c), rn AS (SELECT *, sum(s) OVER (PARTITION BY basin, station ORDER BY date) AS run FROM st), p AS (SELECT *, CAST(mj = 1 AND count(*) OVER (PARTITION BY basin, station, run) >= 2 AS INT) AS masked FROM rn)"
)


@query("q6_mask_persistent", MASKED + " SELECT basin, station, date, masked, CASE WHEN masked = 0 THEN value END AS value FROM p", FULL)
def _(spark, sf):
    return Q.mask_persistent(V.obs(spark, sf), example_flags(spark, sf), 2).select("basin", "station", "date", "masked", "value")


@query("q7_manual_only", MASKED + " SELECT basin, station, date, masked, value FROM p", FULL)
def _(spark, sf):
    return Q.mask_persistent(V.obs(spark, sf), example_flags(spark, sf), 2, manual_only=True).select("basin", "station", "date", "masked", "value")


@query("q4_reasons", STATIC + " SELECT reason_code, count(*) AS n, count(*) FILTER (WHERE reason_code = 'PEER_RESID') AS own FROM static GROUP BY 1", FULL)
def _(spark, sf):
    rows = static_result(spark, sf)
    rows = rows.withColumns({"own": Q.own_signal(F.col("flag")), "text": Q.reason_text(F.col("value"), F.col("peer_median"), F.col("limit"))})
    return rows.where("text IS NOT NULL").groupBy("reason_code").agg(F.count("*").alias("n"), F.sum("own").cast("long").alias("own"))


# Aggregates

ZONES = ("grid", "cells", "bands", "cell_band")


@query("a4_band_means", ", a AS (SELECT band, CAST(count(*) * 2500 AS DOUBLE) AS area_m2 FROM cell_band GROUP BY 1) SELECT date, band, round(avg(value), 9) AS mean_m, any_value(area_m2) AS area_m2, round(avg(value) * any_value(area_m2) * 0.000810714, 4) AS acre_ft FROM grid JOIN cell_band USING (y, x) JOIN a USING (band) GROUP BY date, band", ZONES)
def _(spark, sf):
    out = A.band_means(V.grid(spark, sf), cell_band(spark, sf))
    return out.select("date", "band", F.round("mean_m", 9).alias("mean_m"), "area_m2", F.round("acre_ft", 4).alias("acre_ft"))


@query("a5_a6_survey_volumes", ", a AS (SELECT band, CAST(count(*) AS DOUBLE) * 2500 * 0.000247105 AS acres FROM cell_band WHERE y % 2 = 0 GROUP BY 1) SELECT date, band, round(avg(value) * 3.28084 * any_value(acres), 4) AS acre_ft FROM grid JOIN cell_band USING (y, x) JOIN a USING (band) GROUP BY date, band", ZONES)
def _(spark, sf):
    zones = cell_band(spark, sf)
    acres = A.band_acres(zones, zones.where("y % 2 = 0"))
    return A.survey_volumes(V.grid(spark, sf), zones, acres).withColumn("acre_ft", F.round("acre_ft", 4))


@query("a7_band_counts", " SELECT CAST(ord AS INTEGER) AS ord, bands.band, count(y) AS n FROM bands LEFT JOIN (SELECT * FROM cells WHERE elev < 4000) c ON elev >= lo AND elev < hi GROUP BY ALL ORDER BY 1", ("cells", "bands"))
def _(spark, sf):
    return A.band_counts(V.cells(spark, sf).where("elev < 4000"), V.bands(spark))


@query(
    "a8_baseline",
    ", m AS (SELECT basin, station, CAST(date_trunc('month', date) AS DATE) AS date, CASE WHEN station % 6 = 1 AND year(date) = 1997 THEN 0 ELSE max(value) END AS value FROM obs WHERE date BETWEEN DATE '1995-02-01' AND DATE '2001-06-30' AND NOT (station % 9 = 2 AND month(date) = 4) GROUP BY basin, station, year(date), 3), y AS (SELECT basin, station, year(date) AS yr, sum(value) AS s FROM m GROUP BY ALL), ny AS (SELECT basin, count(DISTINCT year(date)) AS k FROM m GROUP BY 1), g AS (SELECT basin, station FROM y JOIN ny USING (basin) GROUP BY basin, station, k HAVING count(*) FILTER (WHERE s <> 0) = k), n AS (SELECT basin, count(*) AS n FROM g GROUP BY 1), ok AS (SELECT m.* FROM m JOIN g USING (basin, station) WHERE value IS NOT NULL), dd AS (SELECT basin, date FROM ok JOIN n USING (basin) GROUP BY basin, date, n HAVING count(DISTINCT station) = n) SELECT basin, station, date, value FROM ok JOIN dd USING (basin, date)",
    ("obs",),
)
def _(spark, sf):
    rows = V.obs(spark, sf).where("date BETWEEN '1995-02-01' AND '2001-06-30' AND NOT (station % 9 = 2 AND month(date) = 4)")
    m = rows.groupBy("basin", "station", F.trunc("date", "month").alias("date")).agg(F.max("value").alias("value"))
    m = m.withColumn("value", F.when((F.col("station") % 6 == 1) & (F.year("date") == 1997), 0.0).otherwise(F.col("value")))
    return A.baseline(m)


@query("a13_w6_trimmed_votes", ", v AS (SELECT basin, date, station AS peer, value AS miss, 1 + station % 3 AS weight, value < 40 AS ok, count(*) OVER (PARTITION BY basin, date) AS n, row_number() OVER (PARTITION BY basin, date ORDER BY value, station) AS rn FROM obs) SELECT basin, date, count(*) AS votes, round(sum(weight * CAST(ok AS INT)) / sum(weight), 9) AS ok_fraction FROM v WHERE rn <= n - greatest(0, least(floor(n * 0.2), n - 3)) GROUP BY ALL", ("obs",))
def _(spark, sf):
    votes = V.obs(spark, sf).select("basin", "date", F.col("station").alias("peer"), F.col("value").alias("miss"), (1 + F.col("station") % 3).alias("weight"), (F.col("value") < 40).alias("ok"))
    return P.ok_fraction(P.trim_worst(votes, ["basin", "date"], F.col("miss")), ["basin", "date"]).withColumn("ok_fraction", F.round("ok_fraction", 9))


@query("a15_row_summary", " SELECT basin, date, sum(value) AS sum, median(value) AS median, round(avg(value), 9) AS mean, count(value) AS n FROM obs GROUP BY ALL", ("obs",))
def _(spark, sf):
    return A.row_summary(V.obs(spark, sf), ["basin", "date"]).withColumn("mean", F.round("mean", 9))


@query(
    "a17_a18_metrics",
    "SELECT l_returnflag AS band, count(*) AS n, round(1 - var_pop(y - p) / var_pop(y), 9) AS explained_variance, round(avg(abs(y - p)), 6) AS mae, round(avg((y - p) * (y - p)), 5) AS mse, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(pow(ln(1 + y) - ln(1 + p), 2)), 9) AS msle, round(median(abs(y - p)), 6) AS median_ae, round(pow(corr(y, p), 2), 9) AS r2, round(max(abs(y - p)) FILTER (WHERE y >= 50), 6) AS max_abs, round(max(abs(y - p) / y * 100) FILTER (WHERE y >= 50), 6) AS max_pct FROM (SELECT l_returnflag, l_extendedprice / 1000 AS y, l_quantity * 1.5 AS p FROM lineitem) GROUP BY 1",
)
def _(spark, sf):
    rows = V.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("band"), (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_quantity") * 1.5).alias("p"))
    m = A.metrics(rows, ["band"], "y", "p", large=True)
    digits = {"explained_variance": 9, "msle": 9, "r2": 9, "mse": 5}
    return m.select("band", "n", *[F.round(c, digits.get(c, 6)).alias(c) for c in m.columns[2:]])


SURVEY = ", truth AS (SELECT date, band, value FROM labels WHERE basin = 3)"


@query("a19_product_kpi", PRODUCTS + SURVEY + " SELECT name, date, round(max(CASE WHEN p.band = 'total' THEN abs(p.value - t.value) / t.value * 100 END), 6) AS total_error_pct, round(sqrt(avg(CASE WHEN p.band <> 'total' THEN (p.value - t.value) * (p.value - t.value) END)), 4) AS rmse_bands FROM products p JOIN truth t USING (date, band) GROUP BY ALL", ("labels",))
def _(spark, sf):
    truth = V.labels(spark, sf).where("basin = 3").select("date", "band", "value")
    out = A.product_kpi(products(spark, sf), truth)
    return out.select("name", "date", F.round("total_error_pct", 6).alias("total_error_pct"), F.round("rmse_bands", 4).alias("rmse_bands"))


@query("a20_bias", ", b AS (SELECT date, max(value) FILTER (WHERE basin = 0) AS s, max(value) FILTER (WHERE basin = 1) AS m FROM labels WHERE band = 'total' AND basin < 2 GROUP BY date) SELECT round(median(s / m), 9) AS factor, round(avg(s / m), 9) AS mean_ratio, count(s / m) AS n FROM b", ("labels",))
def _(spark, sf):
    wide = V.labels(spark, sf).where("band = 'total' AND basin < 2").groupBy("date").agg(F.max(F.when(F.col("basin") == 0, F.col("value"))).alias("survey"), F.max(F.when(F.col("basin") == 1, F.col("value"))).alias("model"))
    out = A.bias_factor(A.bias(wide, "survey", "model"))
    return out.select(F.round("factor", 9).alias("factor"), F.round("mean_ratio", 9).alias("mean_ratio"), "n")


@query("a21_common_window", PRODUCTS + ", w AS (SELECT max(a) AS s, min(b) AS e FROM (SELECT name, min(date) AS a, max(date) AS b FROM products GROUP BY 1)) SELECT name, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM products, w WHERE date BETWEEN s AND e GROUP BY 1", ("labels",))
def _(spark, sf):
    rows = A.in_common_window(products(spark, sf), "name")
    return rows.groupBy("name").agg(F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query("a22_a23_date_checks", "SELECT o_custkey, count(*) AS n_rows, count(DISTINCT CAST(o_orderdate AS DATE)) AS n_dates, max(CAST(o_orderdate AS DATE)) AS latest, count(*) > count(DISTINCT CAST(o_orderdate AS DATE)) AS repeated FROM orders GROUP BY 1")
def _(spark, sf):
    rows = V.table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"))
    return A.date_checks(rows, ["o_custkey"])


@query("a24_histogram", "SELECT CAST(least(floor((s_acctbal - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bin, count(*) AS n FROM supplier, (SELECT min(s_acctbal) AS lo, max(s_acctbal) AS hi FROM supplier) GROUP BY 1")
def _(spark, sf):
    return A.histogram(V.table(spark, sf, "supplier"), "s_acctbal", 20)


def station_lists(spark, sf):
    rows = V.obs(spark, sf).where("value > 60")
    return rows.groupBy("basin", "date").agg(F.array_join(F.transform(F.sort_array(F.collect_set("station")), lambda x: x.cast("string")), ", ").alias("stations"))


@query(
    "a25_selection_matrix",
    ", s AS (SELECT DISTINCT station, date FROM obs WHERE value > 60) SELECT CAST(a.station AS VARCHAR) AS station, d.date, CAST(s.station IS NOT NULL AS INTEGER) AS picked FROM (SELECT DISTINCT station FROM s) a CROSS JOIN (SELECT DISTINCT date FROM s) d LEFT JOIN s ON s.station = a.station AND s.date = d.date",
    ("obs",),
)
def _(spark, sf):
    return A.selection_presence(station_lists(spark, sf), "stations")


MONTHS = [f"m{i:02d}" for i in range(1, 13)]


@query("a25_selection_by_month", " SELECT CAST(station AS VARCHAR) AS station, " + ", ".join(f"CAST(max(CAST(month(date) = {i} AS INT)) AS INT) AS m{i:02d}" for i in range(1, 13)) + " FROM obs WHERE value > 60 GROUP BY 1", ("obs",))
def _(spark, sf):
    lists = station_lists(spark, sf).withColumn("date", F.date_format("date", "'m'MM"))
    return A.selection_matrix(lists, "stations", MONTHS)


@query("a26_selection_codes", " SELECT station, date, CAST(bit_or(CASE CAST(value % 3 AS INT) WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END) AS INTEGER) AS code FROM obs GROUP BY ALL", ("obs",))
def _(spark, sf):
    season = F.when(F.col("value") % 3 == 0, "season").when(F.col("value") % 3 == 1, "accum").otherwise("melt")
    return A.selection_codes(V.obs(spark, sf).withColumn("season", season), {"season": 1, "accum": 2, "melt": 4})


@query("a27_changed_cells", CLEANED + " SELECT basin, station, date, o.value IS DISTINCT FROM c.value AS changed, c.value IS NOT NULL AS has_value FROM full_obs o LEFT JOIN clean c USING (basin, station, date)", FULL)
def _(spark, sf):
    return A.changed_cells(full(spark, sf), cleaned(spark, sf))


@query("a28_climatology", ", n AS (SELECT basin, station, dayofyear(date) AS doy, median(value) AS normal FROM obs GROUP BY ALL) SELECT o.basin, o.station, o.date, value, normal FROM obs o JOIN n ON n.basin = o.basin AND n.station = o.station AND n.doy = dayofyear(o.date)", ("obs",))
def _(spark, sf):
    return A.climatology(V.obs(spark, sf), ["basin", "station"]).select("basin", "station", "date", "value", "normal")


BANDS5 = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "total"]
SHEET = ", ".join(f"round(max(value) FILTER (WHERE band = '{b}'), 2) AS \"{b}\"" for b in BANDS5)


@query("m14_band_sheet", f" SELECT basin, date, {SHEET} FROM labels GROUP BY ALL", ("labels",))
def _(spark, sf):
    return A.band_sheet(V.labels(spark, sf), ["basin", "date"], BANDS5).select("basin", "date", *[F.round(f"`{b}`", 2).alias(b) for b in BANDS5])


@query(
    "m14_sheet_description",
    " SELECT 'date' AS \"column\", 'day of the prediction' AS meaning, count(date) AS n_values, count(DISTINCT date) AS n_distinct FROM labels UNION ALL SELECT 'band', 'elevation band; total is the basin', count(band), count(DISTINCT band) FROM labels"
    " UNION ALL SELECT 'value', 'volume in acre-feet, whole', count(v), count(DISTINCT v) FROM (SELECT CASE WHEN value >= 1e5 THEN CAST(trunc(value) AS BIGINT) END AS v FROM labels) UNION ALL SELECT 'basin', NULL, count(basin), count(DISTINCT basin) FROM labels",
    ("labels",),
)
def _(spark, sf):
    sheet = V.labels(spark, sf).select("date", "band", F.when(F.col("value") >= 1e5, F.col("value").cast("long")).alias("value"), "basin")
    return A.sheet_description(sheet)


@query("a30_rmse_sheet", ", m AS (SELECT basin, band, sqrt(avg((value - 1e6) * (value - 1e6))) AS value FROM labels GROUP BY ALL) SELECT basin, " + SHEET + " FROM m GROUP BY basin", ("labels",))
def _(spark, sf):
    e = F.col("value") - 1e6
    rmse = V.labels(spark, sf).groupBy("basin", "band").agg(F.sqrt(F.avg(e * e)).alias("rmse"))
    return A.rmse_sheet(rmse, "basin", "band", BANDS5).select("basin", *[F.round(f"`{b}`", 2).alias(b) for b in BANDS5])


# Sets


@query("x1_union_all", " SELECT basin, date, band, round(value, 2) AS value, CAST(NULL AS INTEGER) AS station FROM labels UNION ALL SELECT basin, date, NULL, value, station FROM obs", ("obs", "labels"))
def _(spark, sf):
    labels = V.labels(spark, sf).withColumn("value", F.round("value", 2))
    return A.union_all(labels, V.obs(spark, sf)).select("basin", "date", "band", "value", "station")


@query("x2_common_years", ", w AS (SELECT DISTINCT year(date) + CAST(month(date) >= 10 AS INT) AS wy FROM obs WHERE station = 1 INTERSECT SELECT DISTINCT year(date) + CAST(month(date) >= 10 AS INT) FROM labels WHERE basin = 0 INTERSECT SELECT DISTINCT year(date) + CAST(month(date) >= 10 AS INT) FROM grid WHERE year(date) < 2000) SELECT CAST(wy AS INTEGER) AS wy FROM w ORDER BY 1", ("obs", "labels", "grid"))
def _(spark, sf):
    years = lambda d: d.select(U.water_year(F.col("date")).alias("wy")).distinct()
    return A.common_years(years(V.obs(spark, sf).where("station = 1")), years(V.labels(spark, sf).where("basin = 0")), years(V.grid(spark, sf).where(F.year("date") < 2000)))


@query("x4_difference", " SELECT DISTINCT date FROM obs WHERE date NOT IN (SELECT date FROM labels)", ("obs", "labels"))
def _(spark, sf):
    return V.obs(spark, sf).select("date").subtract(V.labels(spark, sf).select("date"))


@query("x5_networks", "SELECT s_suppkey AS id, s_name AS name, 'snow' AS network, round(s_acctbal, 4) AS elev_m FROM supplier UNION ALL SELECT c_custkey, c_name, 'cdec', round(c_acctbal * 0.3048, 4) FROM customer")
def _(spark, sf):
    a = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("SNOW").alias("network"), F.col("s_acctbal").alias("elev_m"))
    b = V.table(spark, sf, "customer").select("c_custkey", "c_name", F.lit("CDEC").alias("network"), "c_acctbal")
    out = A.combine_networks(a, b, {"c_custkey": "id", "c_name": "name", "c_acctbal": "elev_m"}, ["elev_m"])
    return out.withColumn("elev_m", F.round("elev_m", 4))


@query("x3_union_set", " SELECT DISTINCT station FROM obs WHERE value > 150 UNION SELECT DISTINCT station FROM obs WHERE station % 5 = 0", ("obs",))
def _(spark, sf):
    obs = V.obs(spark, sf)
    return A.union_set(obs.where("value > 150").select("station"), obs.where("station % 5 = 0").select("station"))


@query(
    "m14_station_sheet",
    ", s AS (SELECT basin, date, list_sort(list(DISTINCT station) FILTER (WHERE value > 40)) AS hi, list_sort(list(DISTINCT station) FILTER (WHERE value <= 40)) AS lo FROM obs GROUP BY ALL) SELECT basin, date, array_to_string(hi, ', ') AS high, array_to_string(lo, ', ') AS low FROM s",
    ("obs",),
)
def _(spark, sf):
    band = F.when(F.col("value") > 40, "high").otherwise("low").alias("band")
    lists = V.obs(spark, sf).groupBy("basin", "date", band).agg(F.sort_array(F.collect_set("station")).alias("value"))
    return A.band_sheet(lists, ["basin", "date"], ["high", "low"], lists=True)
