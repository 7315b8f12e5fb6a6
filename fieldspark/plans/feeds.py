"""Queries of sources, cleaning, units, filters and calendars."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldspark.functions import clean as C
from fieldspark.functions import units as U
from fieldspark.operators import calendars as K
from fieldspark.plans.catalog import query
from fieldspark.sources import io as S
from fieldspark.sources import views as V
from fieldspark.sources.tables import scratch


@query("s1_s2_series_dates", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderdate IS NOT NULL ORDER BY 1 DESC")
def _(spark, sf):
    series = S.read_series(spark, f"{sf}/orders.parquet", date="o_orderdate")
    return S.series_dates(series, "o_orderdate").withColumnRenamed("o_orderdate", "date")


@query("s3_s4_csv_to_parquet", "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS level FROM supplier")
def _(spark, sf):
    path = scratch(spark, "csv")
    rows = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("level"))
    rows.write.csv(f"{path}/in", header=True)
    schema = "id long, name string, level double"
    return S.csv_to_parquet(spark, f"{path}/in", f"{path}/out", schema).unionByName(S.read_csv_or_empty(spark, f"{path}/none", schema))


@query(
    "s5_s18_wide_to_long",
    ", m AS (SELECT date, station, sum(value) AS value FROM obs GROUP BY ALL), d AS (SELECT DISTINCT date FROM m), s AS (SELECT DISTINCT station FROM m) SELECT d.date, CAST(s.station AS VARCHAR) AS station, m.value FROM d CROSS JOIN s LEFT JOIN m USING (date, station)",
    ("obs",),
)
def _(spark, sf):
    wide = V.obs(spark, sf).groupBy("date").pivot("station").agg(F.sum("value"))
    return S.wide_to_long(wide)


@query("s6_station_feed", "SELECT station, CAST(ts AS DATE) AS date, round(avg(value), 6) AS value FROM (SELECT station, ts, CASE WHEN seq % 10 = 0 THEN NULL ELSE value * 25.4 END AS value FROM feed WHERE sensor = 'view') GROUP BY ALL", ("feed",))
def _(spark, sf):
    """Landed CSV-like text through lenient dates, lenient numbers, sentinels, units and the daily mean."""
    raw = V.raw_feed(spark, sf).where("sensor = 'view'").select("station", "seq", F.date_format("ts", "yyyyMMdd HHmm").alias("obs_date"), F.when(F.col("seq") % 10 == 0, "-9999").otherwise(F.col("value").cast("string")).alias("text"))
    raw = C.lenient_number(raw, "text", "value").withColumn("ts", C.lenient_timestamp(F.col("obs_date")))
    out = K.daily(raw.withColumn("value", U.convert(C.clean_value(F.col("value")), "in", "mm")))
    return out.select("station", "date", F.round("value", 6).alias("value"))


@query("s7_json_fields", "SELECT event_id, CAST(ts AS DATE) AS date, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events")
def _(spark, sf):
    e = V.table(spark, sf, "events").select("event_id", F.concat(F.lit('{"obsDate": "'), F.date_format("ts", "yyyy-MM-dd"), F.lit('", '), F.substring("props", 2, 1000)).alias("json"))
    date, value = S.json_fields(F.col("json"), ["date", "obsDate", "DATE"], ["value", "k"])
    return e.select("event_id", date.try_cast("date").alias("date"), value.try_cast("double").alias("value"))


@query("s8_course_feed", "SELECT station, CAST(date_trunc('month', ts) AS DATE) AS month, max(value) AS value FROM feed WHERE sensor = 'signup' GROUP BY ALL", ("feed",))
def _(spark, sf):
    feed = V.raw_feed(spark, sf).where("sensor = 'signup'").withColumn("date", F.to_date("ts"))
    return K.monthly(feed, how="max")


@query("s9_long_parameter", "SELECT event_id, value FROM events WHERE event_type IN ('click', 'view') AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def _(spark, sf):
    names = F.when(F.col("event_type") == "click", "Snow SWE mm").when(F.col("event_type") == "view", "Water  Content (in)").otherwise("Depth")
    long = V.table(spark, sf, "events").withColumn("parameter", names)
    return S.long_parameter(long).where(F.to_date("ts").between("2024-01-05", "2024-01-20")).select("event_id", "value")


@query("s10_quality_level", "SELECT l_orderkey, l_linenumber, round(l_quantity * 25.4, 6) AS value FROM lineitem WHERE l_linenumber = 1 AND l_quantity <> 10")
def _(spark, sf):
    rows = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_linenumber").cast("string").alias("quality_control_level_code"), F.when(F.col("l_quantity") == 10, -9999.0).otherwise(F.col("l_quantity")).alias("v"))
    return S.quality_level(rows).select("l_orderkey", "l_linenumber", F.round(U.convert(C.clean_value(F.col("v")), "in", "mm"), 6).alias("value")).where("value IS NOT NULL")


@query("s11_product_series", "SELECT date, value FROM obs WHERE station = 3 AND date >= DATE '1999-10-01'", ("obs",))
def _(spark, sf):
    return S.product_series(V.obs(spark, sf), 3, 2000, "value")


@query("s12_s13_discovery", ", w AS (SELECT year(date) + CAST(month(date) >= 10 AS INT) AS wy, * FROM grid) SELECT wy, count(*) AS n, sum(value) AS total FROM w WHERE wy IN (1997, 1998) GROUP BY wy", ("grid",))
def _(spark, sf):
    path = scratch(spark, "grid")
    rows = V.grid(spark, sf).withColumn("wy", U.water_year(F.col("date")))
    S.write_partitioned(rows, path, ["wy"])
    years = S.discover(spark.read.parquet(path), r"wy=(\d{4})", "int")
    picked = S.read_grid(spark, path, "part", [1997, 1998])
    return picked.join(F.broadcast(years.select(F.col("found").alias("wy"))), "wy").groupBy("wy").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query(
    "s13_s14_names",
    "SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 2000 + o_orderkey % 20 END AS INTEGER) AS wy, CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day, CASE o_orderkey % 4 WHEN 0 THEN 'peers' WHEN 1 THEN 'grid' END AS model, CASE o_orderkey % 5 WHEN 0 THEN 'accum' WHEN 1 THEN 'melt' ELSE 'season' END AS season FROM orders",
)
def _(spark, sf):
    k = F.col("o_orderkey")
    orders = V.table(spark, sf, "orders").withColumns(
        {
            "year_name": F.when(k % 3 == 0, "none").otherwise(F.concat(F.lit("pillow_WY"), (2000 + k % 20).cast("string"), F.lit(".csv"))),
            "day_name": F.when(k % 3 == 1, "none.nc").otherwise(F.concat(F.lit("survey_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".nc"))),
            "path": F.concat(F.lit("out/"), F.when(k % 4 == 0, "Peers").when(k % 4 == 1, "grid").otherwise("other"), F.when(k % 5 == 0, "_accum").when(k % 5 == 1, "_melt").otherwise(""), F.lit("/p.csv")),
        }
    )
    model, season = S.model_of_path(F.col("path"))
    return orders.select("o_orderkey", S.water_year_of_name(F.col("year_name")).alias("wy"), S.date_of_name(F.col("day_name")).alias("day"), model.alias("model"), season.alias("season"))


@query("s15_last_rows", "SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 2")
def _(spark, sf):
    rows = V.table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("date"))
    return S.last_rows(rows, ["o_custkey"], [F.desc("date"), F.desc("o_orderkey")], 2)


@query("s16_s17_incremental", "SELECT basin, date, count(*) AS n, sum(value) AS total FROM obs GROUP BY ALL", ("obs",))
def _(spark, sf):
    path = scratch(spark, "means")
    means = V.obs(spark, sf).groupBy("basin", "date").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    S.append_new_dates(means.where("date < '1995-09-01'"), path, ["basin", "date"])
    return S.append_new_dates(means, path, ["basin", "date"])


@query("s17_replace_and_checklist", "SELECT basin, date, count(*) AS n, sum(value) AS total, CASE WHEN date < DATE '1999-01-01' AND day(date) <> 17 THEN 1 ELSE 2 END AS run FROM obs GROUP BY ALL", ("obs",))
def _(spark, sf):
    """Daily means committed three times: with wrong days, corrected and continued, and repeated without any change."""
    path, log = scratch(spark, "means"), scratch(spark, "checklist")
    means = V.obs(spark, sf).groupBy("basin", "date").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    wrong = means.withColumn("total", F.when(F.day("date") == 17, F.col("total") + 1000).otherwise(F.col("total")))
    S.commit_dates(wrong.where("date < '1999-01-01'"), path, log)
    S.commit_dates(means, path, log)
    return S.commit_dates(means, path, log).join(S.checklist(spark, log).select("date", "run"), "date")


PREDICTED = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice AS value, CASE o_custkey % 3 WHEN 0 THEN 'peers' WHEN 1 THEN 'grid' END AS model, CASE o_custkey % 4 WHEN 0 THEN 'accum' WHEN 1 THEN 'melt' ELSE 'season' END AS season FROM orders"


@query("s14_s15_last_rows_of_files", f"SELECT model, season, o_orderkey, date, value FROM ({PREDICTED}) WHERE model IS NOT NULL QUALIFY row_number() OVER (PARTITION BY model, season ORDER BY date DESC, o_orderkey DESC) <= 2")
def _(spark, sf):
    """Prediction files by model and season, written in order of date; the last two rows of each of a known model."""
    k = F.col("o_custkey")
    name = F.concat(F.when(k % 3 == 0, "peers").when(k % 3 == 1, "grid").otherwise("other"), F.when(k % 4 == 0, "_accum").when(k % 4 == 1, "_melt").otherwise(""))
    rows = V.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("value"), name.alias("run"))
    path = scratch(spark, "predictions")
    rows.repartition("run").sortWithinPartitions("run", "date", "o_orderkey").write.partitionBy("run").parquet(path)
    found = S.scan_files(spark.read.parquet(path))
    model, season = S.model_of_path(F.regexp_extract("file", "(run=[^/]*/[^/]*)$", 1))
    found = S.last_of_files(found.withColumns({"model": model, "season": season}).where("model IS NOT NULL"))
    return found.select("model", "season", "o_orderkey", "date", "value")


@query("s19_register_survey", "SELECT date, y, x, value FROM grid WHERE date = DATE '1998-03-01' AND y IN (SELECT y FROM cells WHERE elev >= 4000)", ("grid", "cells"))
def _(spark, sf):
    path = scratch(spark, "survey")
    S.register_survey(V.grid(spark, sf).where("date = '1998-03-01'"), V.cells(spark, sf).where("elev >= 4000"), path)
    return spark.read.parquet(path).select(F.col("date").cast("date").alias("date"), "y", "x", "value")


@query("t1_lenient_timestamp", "SELECT event_id, CASE event_id % 5 WHEN 2 THEN date_trunc('day', ts) ELSE date_trunc('minute', ts) END AS ts FROM events")
def _(spark, sf):
    k, ts = F.col("event_id") % 5, F.col("ts")
    raw = V.table(spark, sf, "events").select(
        "event_id",
        F.when(k == 0, F.date_format(ts, "yyyyMMdd HHmm")).when(k == 1, F.date_format(ts, "yyyy-MM-dd HH:mm")).when(k == 2, F.date_format(ts, "yyyyMMdd")).alias("obs_date"),
        F.when(k == 3, F.date_format(ts, "yyyyMMdd")).when(k == 4, F.date_format(ts, "yyyy-MM-dd HH:mm:00")).alias("date"),
        F.when(k == 3, F.regexp_replace(F.date_format(ts, "HHmm"), "^0", "")).alias("time"),
    )
    return raw.select("event_id", C.lenient_timestamp(F.col("obs_date"), F.col("date"), F.col("time")).alias("ts"))


@query("t2_lenient_number", "SELECT event_id, CASE WHEN event_type IN ('click', 'view') OR event_id % 3 > 0 THEN value END AS value FROM events")
def _(spark, sf):
    text = F.when(F.col("event_type").isin("click", "view"), F.concat(F.col("value").cast("string"), F.lit(" mm"))).when(F.col("event_id") % 3 > 0, F.col("value").cast("string")).otherwise("---")
    raw = V.table(spark, sf, "events").select("event_id", "event_type", text.alias("text"))
    return C.lenient_number(raw, "text", "value", ["event_type"]).select("event_id", "value")


@query("c1_sentinels", "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN value END AS value FROM events")
def _(spark, sf):
    k = F.col("event_id") % 4
    raw = F.when(k == 0, -9999.0).when(k == 1, -999.0).when(k == 2, float("nan")).otherwise(F.col("value"))
    return V.table(spark, sf, "events").select("event_id", C.clean_value(raw).alias("value"))


@query("c2_best_column", "SELECT event_type AS sensor, CASE event_type WHEN 'error' THEN 'candidate value' WHEN 'click' THEN 'W.C.' ELSE 'snow water equivalent' END AS col FROM events GROUP BY ALL")
def _(spark, sf):
    """Blocked words (with numbers below them), columns without a number and numbers with a unit beside the wanted one."""
    sensor, v = F.col("event_type"), F.col("value").cast("string")
    columns = {
        "Measured Date": v, "Elevation": v, "Site ID": v, "Unnamed: 5": v, "raw count": v, "candidate value": F.concat(v, F.lit(" in")), "water content": F.lit("x"),
        "W.C.": F.when(sensor == "click", v).otherwise("n/a"), "snow water equivalent": F.when(sensor.isin("error", "click"), "n/a").otherwise(v),
    }
    tab = V.table(spark, sf, "events").select(sensor.alias("sensor"), *[c.alias(n) for n, c in columns.items()])
    return C.best_column(tab, ["sensor"], list(columns)).select("sensor", F.col("column").alias("col"))


@query(
    "c3_prefer_sensor",
    ", d AS (SELECT station, sensor, CAST(ts AS DATE) AS date, max(value) AS value FROM feed GROUP BY ALL) SELECT station, date, coalesce(max(value) FILTER (WHERE sensor = 'view'), max(value) FILTER (WHERE sensor = 'click')) AS value FROM d WHERE sensor IN ('view', 'click') GROUP BY ALL",
    ("feed",),
)
def _(spark, sf):
    daily = V.raw_feed(spark, sf).groupBy("station", "sensor", F.to_date("ts").alias("date")).agg(F.max("value").alias("value"))
    return C.prefer_sensor(daily, ["station", "date"], "view", "click")


@query("c3_fullest_sensor", ", n AS (SELECT station, sensor, count(value) AS n FROM feed GROUP BY ALL) SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY station ORDER BY n DESC, sensor) = 1", ("feed",))
def _(spark, sf):
    return C.fullest_sensor(V.raw_feed(spark, sf), ["station"])


@query(
    "c4_monthly_sensors",
    "SELECT station, number, row_number() OVER (PARTITION BY station ORDER BY CASE number WHEN 7 THEN 1 WHEN 3 THEN 2 WHEN 11 THEN 3 ELSE 4 END, number) AS rank FROM (SELECT DISTINCT p_brand AS station, p_size AS number FROM part WHERE p_partkey % 2 = 0 AND p_type IN ('ECONOMY', 'STANDARD')) QUALIFY rank <= 8",
)
def _(spark, sf):
    p = V.table(spark, sf, "part")
    sensors = p.select(F.col("p_brand").alias("station"), F.concat(F.lit("sensor "), F.col("p_size").cast("string")).alias("sensor"), F.when(F.col("p_partkey") % 2 == 0, "(Monthly)").otherwise("daily").alias("duration"), F.when(F.col("p_type").isin("ECONOMY", "STANDARD"), "Snow Water").otherwise("TEMP").alias("kind"))
    return C.monthly_sensors(sensors, priority=(7, 3, 11))


@query(
    "c5_station_kind",
    ", d AS (SELECT station, CAST(ts AS DATE) AS date, max(value) AS v FROM feed WHERE value > 50 GROUP BY ALL), cal AS (SELECT s.station, CAST(c.d AS DATE) AS date FROM (SELECT DISTINCT station FROM feed) s, (SELECT unnest(generate_series(DATE '2023-12-20', DATE '2024-02-10', INTERVAL 1 DAY)) AS d) c), j AS (SELECT cal.*, d.v FROM cal LEFT JOIN d USING (station, date)) SELECT station, round(avg(CAST(v IS NOT NULL AS INT)), 9) AS coverage, count(DISTINCT CASE WHEN v IS NOT NULL THEN date_trunc('month', date) END) AS months, CASE WHEN avg(CAST(v IS NOT NULL AS INT)) >= 0.15 THEN 'pillow' WHEN count(DISTINCT CASE WHEN v IS NOT NULL THEN date_trunc('month', date) END) >= 2 THEN 'snow_course' ELSE 'unknown' END AS kind FROM j GROUP BY station",
    ("feed",),
)
def _(spark, sf):
    feed = V.raw_feed(spark, sf)
    daily = feed.where("value > 50").groupBy("station", F.to_date("ts").alias("date")).agg(F.max("value").alias("value"))
    span = spark.range(1).select(F.explode(F.expr("sequence(date'2023-12-20', date'2024-02-10', interval 1 day)")).alias("date"))
    cal = feed.select("station").distinct().crossJoin(F.broadcast(span)).join(daily, ["station", "date"], "left")
    return C.station_kind(cal).withColumn("coverage", F.round("coverage", 9))


@query(
    "c5_listed_kind",
    ", d AS (SELECT station, min(CAST(ts AS DATE)) AS a, count(DISTINCT CASE WHEN value IS NOT NULL THEN date_trunc('month', ts) END) AS months, avg(CAST(value IS NOT NULL AS INT)) AS coverage FROM feed GROUP BY station) SELECT station, CASE WHEN station % 4 = 0 THEN 'pillow' WHEN station % 4 = 1 THEN 'snow_course' WHEN coverage >= 0.15 THEN 'pillow' WHEN months >= 2 THEN 'snow_course' ELSE 'unknown' END AS kind FROM d",
    ("feed",),
)
def _(spark, sf):
    """The listed durations decide before coverage and months do; a daily one goes before a monthly one."""
    k = F.col("station") % 4
    listed = F.when((k == 0) & (F.col("seq") % 2 == 0), "(Event)").when(k == 0, "Daily").when((k == 1), "(Monthly)").when(k == 2, "annual")
    return C.station_kind(V.raw_feed(spark, sf).withColumns({"date": F.to_date("ts"), "listed": listed}), durations="listed").select("station", "kind")


@query("c6_header_names", "SELECT n_nationkey AS station, n_name AS name, n_regionkey AS network FROM nation")
def _(spark, sf):
    return C.normalize_headers(V.table(spark, sf, "nation"), {r"nation\s*key": "station", r"name": "name", r"region": "network"})


@query("c7_html_facts", "SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, len(regexp_extract_all(html, '(?i)<a\\s')) AS n_links FROM pages")
def _(spark, sf):
    pages = V.table(spark, sf, "pages").withColumn("f", C.html_facts(F.col("html")))
    return pages.select("page_id", "f.title", "f.n_links")


@query(
    "c7_html_location",
    "SELECT s_suppkey, CASE WHEN s_suppkey % 5 > 0 THEN s_suppkey % 90 + 0.25 END AS lat, CASE WHEN s_suppkey % 5 > 0 THEN -(s_suppkey % 180) - 0.5 END AS lon, CASE WHEN s_suppkey % 7 > 0 THEN CAST(s_suppkey * 37 + 900 AS DOUBLE) END AS elev_ft FROM supplier",
)
def _(spark, sf):
    """Station pages as text: pairs and lone latitudes, elevations with separators, and in metres."""
    k = F.col("s_suppkey")
    lat, lon = F.format_string("Latitude  %.2f&deg; N", k % 90 + F.lit(0.25)), F.format_string("<td>LONGITUDE %.1f</td>", -(k % 180) - F.lit(0.5))
    html = F.concat(F.lit("<b>"), lat, F.when(k % 5 > 0, F.concat(F.lit("<br>"), lon)).otherwise(""), F.lit("</b> Elevation "), F.format_number(k * 37 + 900, 0), F.when(k % 7 > 0, " ft").otherwise(" m"))
    return V.table(spark, sf, "supplier").withColumn("at", C.html_location(html)).select("s_suppkey", "at.lat", "at.lon", "at.elev_ft")


@query("c8_course_cadence", "SELECT p_brand AS station, bool_and(p_partkey % 7 < 6) AS monthly FROM part WHERE p_size IN (18, 3, 82) GROUP BY ALL")
def _(spark, sf):
    p = V.table(spark, sf, "part").select(F.col("p_brand").alias("station"), F.col("p_size").alias("number"), F.when(F.col("p_partkey") % 7 < 6, "Monthly").otherwise("hourly").alias("duration"))
    return C.course_cadence(p)


@query(
    "u1_u2_units",
    "SELECT s_suppkey, round(s_acctbal * 0.3048, 6) AS m, round(s_acctbal * 25.4, 6) AS mm, round(s_acctbal * 0.0393701, 6) AS inch, round(s_acctbal * 3.28084, 6) AS ft, round(s_acctbal * 0.000247105, 9) AS acre, round(s_acctbal * 2500 * 0.000810714, 6) AS acre_ft, greatest(s_acctbal, 0.0) AS clipped FROM supplier",
)
def _(spark, sf):
    v = F.col("s_acctbal")
    return V.table(spark, sf, "supplier").select(
        "s_suppkey",
        F.round(U.convert(v, "ft", "m"), 6).alias("m"),
        F.round(U.convert(v, "in", "mm"), 6).alias("mm"),
        F.round(U.convert(v, "mm", "in"), 6).alias("inch"),
        F.round(U.convert(v, "m", "ft"), 6).alias("ft"),
        F.round(U.convert(v, "m2", "acre"), 9).alias("acre"),
        F.round(U.acre_feet(v, F.lit(U.CELL_M2)), 6).alias("acre_ft"),
        U.clip_negative(v).alias("clipped"),
    )


@query(
    "u3_band_sum",
    " SELECT basin, date, CAST(trunc(sum(CASE WHEN band <> 'total' THEN CAST(trunc(value) AS BIGINT) END) / 1000) AS BIGINT) AS band_sum, CAST(trunc(max(CASE WHEN band = 'total' THEN CAST(trunc(value) AS BIGINT) END) / 1000) AS BIGINT) AS basin_total FROM labels GROUP BY ALL",
    ("labels",),
)
def _(spark, sf):
    return U.band_sum_taf(V.labels(spark, sf), ["basin", "date"])


@query("u4_band_labels", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '<7k' WHEN 1 THEN '7k-8k' WHEN 2 THEN 'total' ELSE '>12k' END AS label FROM part")
def _(spark, sf):
    k = F.col("p_partkey") % 4
    raw = F.when(k == 0, "<7000").when(k == 1, "7000 – 8000").when(k == 2, "Basin").otherwise(">12000")
    return V.table(spark, sf, "part").select("p_partkey", U.band_label(raw).alias("label"))


@query("u5_distinct_labels", "SELECT p_partkey, p_name || CASE WHEN row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) > 1 THEN ' (' || (row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) - 1) || ')' ELSE '' END AS p_name FROM part")
def _(spark, sf):
    return U.distinct_labels(V.table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", ["p_partkey"])


@query("u6_pick_modes", "SELECT min(m) FILTER (WHERE m LIKE '%Drop%') AS drop_mode, min(m) FILTER (WHERE m LIKE '%Predict%') AS predict_mode FROM (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'Drop NaNs' WHEN 1 THEN 'Predict NaNs' END AS m FROM orders)")
def _(spark, sf):
    m = F.when(F.col("o_orderkey") % 3 == 0, "Drop NaNs").when(F.col("o_orderkey") % 3 == 1, "Predict NaNs")
    return U.pick_modes(V.table(spark, sf, "orders").select(m.alias("mode")), "mode")


@query(
    "u7_u8_water_dates",
    ", d AS (SELECT DISTINCT date, year(date) + CAST(month(date) >= 10 AS INT) AS wy FROM obs), w AS (SELECT *, date_diff('day', make_date(wy - 1, 10, 1), date) + 1 AS wday FROM d) SELECT date, CAST(wy AS INTEGER) AS wy, CAST(wday AS INTEGER) AS wday, round(sin(2 * pi() * wday / 365.25), 9) AS s, round(cos(2 * pi() * wday / 365.25), 9) AS c, strftime(date, '%Y%m%d') AS compact, strftime(date, '%Y%m%d') AS padded FROM w",
    ("obs",),
)
def _(spark, sf):
    d = F.col("date")
    s, c = U.season_angle(d)
    return V.obs(spark, sf).select("date").distinct().select(
        "date", U.water_year(d).alias("wy"), U.water_day(d).alias("wday"), F.round(s, 9).alias("s"), F.round(c, 9).alias("c"), U.compact_date(d).alias("compact"), U.padded_date(F.year(d), F.month(d), F.day(d)).alias("padded")
    )


@query("u9_bands", " SELECT y, x, elev, band FROM cells JOIN bands ON elev >= lo AND elev < hi", ("cells", "bands"))
def _(spark, sf):
    return U.with_band(V.cells(spark, sf), "elev", V.bands(spark)).select("y", "x", "elev", "band")


@query("u10_u11_index_box", " SELECT date, sum(value) AS total FROM grid WHERE y BETWEEN 2 AND 9 AND x BETWEEN 1 AND 3 GROUP BY date", ("grid",))
def _(spark, sf):
    rows = U.index_box(V.grid(spark, sf).withColumnRenamed("value", "model_swe"), (2, 9), (1, 3))
    return rows.groupBy("date").agg(F.sum(U.pick_column(rows.columns, ["aso_swe"])).alias("total"))


@query("u12_abbreviations", "SELECT n_nationkey, 'NAT' || CASE WHEN row_number() OVER (ORDER BY n_nationkey) > 1 THEN CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS VARCHAR) ELSE '' END AS code FROM nation")
def _(spark, sf):
    return U.abbreviations(V.table(spark, sf, "nation"), "n_name", "n_nationkey").select("n_nationkey", "code")


@query("f1_water_year_slice", " SELECT basin, station, date, value FROM obs WHERE date BETWEEN DATE '1998-10-01' AND DATE '1999-10-01'", ("obs",))
def _(spark, sf):
    return K.water_year_slice(V.obs(spark, sf), 1999)


@query(
    "f2_split",
    " SELECT basin, count(*) FILTER (WHERE date >= DATE '1998-10-01' AND date < DATE '1999-10-01') AS n_test, count(*) FILTER (WHERE date < DATE '1998-10-01') AS n_train, count(*) FILTER (WHERE NOT (date >= DATE '1998-10-01' AND date < DATE '1999-10-01')) AS n_others, count(*) FILTER (WHERE date >= DATE '1996-01-01' AND date < DATE '1998-10-01') AS n_qa, count(*) FILTER (WHERE date >= DATE '1996-01-01' AND date < DATE '2001-01-01' AND NOT (date >= DATE '1998-10-01' AND date < DATE '1999-10-01')) AS n_qa2 FROM obs GROUP BY basin",
    ("obs",),
)
def _(spark, sf):
    a = K.split_rows(V.obs(spark, sf), 1999, qa_from="1996-01-01")
    a = a.withColumnsRenamed({"is_test": "t", "is_train": "r", "is_qa": "q"})
    b = K.split_rows(a, 1999, "others", "1996-01-01", True, "2001-01-01")
    return b.groupBy("basin").agg(F.count_if("t").alias("n_test"), F.count_if("r").alias("n_train"), F.count_if("is_train").alias("n_others"), F.count_if("q").alias("n_qa"), F.count_if("is_qa").alias("n_qa2"))


@query(
    "f3_exclusions",
    ", r(station, a, b) AS (VALUES (1, NULL, NULL), (2, DATE '1997-01-01', DATE '1998-12-31'), (3, DATE '2000-06-01', NULL), (2, DATE '1998-06-01', DATE '1999-03-01'), (4, NULL, DATE '1996-01-01')) SELECT basin, station, date, CASE WHEN NOT hit THEN value END AS value, hit AS excluded FROM (SELECT *, EXISTS (SELECT 1 FROM r WHERE r.station = obs.station AND date BETWEEN coalesce(a, DATE '0001-01-01') AND coalesce(b, DATE '9999-12-31')) AS hit FROM obs)",
    ("obs",),
)
def _(spark, sf):
    ranges = [(1, None, None), (2, "1997-01-01", "1998-12-31"), (3, "2000-06-01", None), (2, "1998-06-01", "1999-03-01"), (4, None, "1996-01-01")]
    ranges = spark.createDataFrame(ranges, "station int, start string, end string").select("station", F.col("start").cast("date"), F.col("end").cast("date"))
    return K.exclude(V.obs(spark, sf), ranges).select("basin", "station", "date", "value", "excluded")


@query("f4_enough_values", " SELECT basin, station, round(avg(CAST(value IS NULL AS INT)), 9) AS missing FROM full_obs GROUP BY ALL HAVING avg(CAST(value IS NULL AS INT)) < 0.45", ("obs", "days", "full_obs"))
def _(spark, sf):
    return K.enough_values(K.daily_calendar(V.obs(spark, sf)), max_missing=0.45).withColumn("missing", F.round("missing", 9))


@query(
    "f5_missing_ranking",
    ", d AS (SELECT DISTINCT date FROM obs), s AS (SELECT DISTINCT station FROM obs) SELECT CAST(s.station AS VARCHAR) AS \"column\", round(100.0 * avg(CAST(o.value IS NULL AS INT)), 6) AS missing_pct FROM d CROSS JOIN s LEFT JOIN (SELECT date, station, sum(value) AS value FROM obs GROUP BY ALL) o USING (date, station) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    ("obs",),
)
def _(spark, sf):
    wide = V.obs(spark, sf).groupBy("date").pivot("station").agg(F.sum("value"))
    return K.missing_ranking(wide, [c for c in wide.columns if c != "date"]).withColumn("missing_pct", F.round("missing_pct", 6))


@query("f6_display_rows", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '5-LOW' THEN 'Low' ELSE o_orderpriority END AS model FROM orders WHERE o_orderstatus <> 'P'")
def _(spark, sf):
    rows = V.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("model"), F.concat(F.lit(" "), "o_orderstatus").alias("mode"), "o_totalprice")
    return K.display_rows(rows, "mode", "P", ["mode", "o_totalprice"], {"1-URGENT": "Urgent", "5-LOW": "Low"})


@query("j1_calendar", " SELECT basin, station, date, value FROM full_obs", ("obs", "days", "full_obs"))
def _(spark, sf):
    return K.daily_calendar(V.obs(spark, sf)).select("basin", "station", "date", "value")


@query(
    "a1_a3_daily",
    " SELECT station, CAST(ts AS DATE) AS date, round(avg(value), 6) AS mean, arg_min(value, (ts, seq)) AS first FROM feed GROUP BY ALL",
    ("feed",),
)
def _(spark, sf):
    feed = V.raw_feed(spark, sf)
    mean = K.daily(feed).withColumn("mean", F.round("value", 6)).drop("value")
    return mean.join(K.daily(feed, how="first").withColumnRenamed("value", "first"), ["station", "date"])


@query("a2_monthly", " SELECT basin, station, CAST(date_trunc('month', date) AS DATE) AS month, arg_min(value, date) AS value FROM obs GROUP BY ALL", ("obs",))
def _(spark, sf):
    return K.monthly(V.obs(spark, sf), ["basin", "station"], "first")


@query(
    "w9_interpolate",
    ", o AS (SELECT *, max(date) FILTER (WHERE value IS NOT NULL) OVER (PARTITION BY basin, station ORDER BY date) AS a, min(date) FILTER (WHERE value IS NOT NULL) OVER (PARTITION BY basin, station ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM full_obs) SELECT o.basin, o.station, o.date, round(CASE WHEN o.value IS NOT NULL THEN o.value ELSE x.value + (y.value - x.value) * date_diff('day', o.a, o.date) / date_diff('day', o.a, o.b) END, 6) AS value FROM o LEFT JOIN obs x ON x.basin = o.basin AND x.station = o.station AND x.date = o.a LEFT JOIN obs y ON y.basin = o.basin AND y.station = o.station AND y.date = o.b",
    ("obs", "days", "full_obs"),
)
def _(spark, sf):
    out = K.interpolate(K.daily_calendar(V.obs(spark, sf)))
    return out.select("basin", "station", "date", F.round("value", 6).alias("value"))


@query("x6_todo_dates", ", done AS (SELECT DISTINCT date FROM obs WHERE date < DATE '2000-01-01') SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series((SELECT max(date) FROM done) + INTERVAL 1 DAY, TIMESTAMP '2000-02-15', INTERVAL 1 DAY)) AS d)", ("obs",))
def _(spark, sf):
    return K.todo_dates(V.obs(spark, sf).where("date < '2000-01-01'").select("date").distinct(), "2000-02-15")


@query("x7_failed_days", ", p AS (SELECT * FROM labels WHERE month(date) <> 6), c AS (SELECT DISTINCT date FROM labels), l AS (SELECT DISTINCT basin, band FROM p) SELECT c.date, l.basin, l.band, p.value FROM c CROSS JOIN l LEFT JOIN p USING (date, basin, band)", ("labels",))
def _(spark, sf):
    labels = V.labels(spark, sf)
    return K.fill_failed_days(labels.where(F.month("date") != 6), labels.select("date"), ["basin", "band"]).select("date", "basin", "band", "value")
