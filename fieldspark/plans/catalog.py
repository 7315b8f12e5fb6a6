"""The registered queries with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: SQL of the views in fieldspark.sources.views.
VIEWS = {
    "obs": "SELECT n_regionkey AS basin, s_nationkey AS station, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS value FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL",
    "obs_wide_load": "SELECT n_regionkey AS basin, l_suppkey AS station, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS value FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL",
    "labels": "SELECT n_regionkey AS basin, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, band, sum(o_totalprice) AS value FROM (SELECT *, unnest([o_orderpriority, 'total']) AS band FROM orders) JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL",
    "grid": "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, l_suppkey AS y, CAST(l_linenumber AS BIGINT) AS x, sum(l_quantity) AS value FROM lineitem GROUP BY ALL",
    "cells": "SELECT y, x, s_acctbal AS elev FROM (SELECT DISTINCT l_suppkey AS y, CAST(l_linenumber AS BIGINT) AS x FROM lineitem) JOIN supplier ON y = s_suppkey",
    "feed": "SELECT user_id AS station, event_type AS sensor, ts, event_id AS seq, value, props FROM events",
    "bands": "SELECT * FROM (VALUES (0, '<1k', '-inf'::DOUBLE, 1000.0::DOUBLE), (1, '1k-4k', 1000.0, 4000.0), (2, '4k-7k', 4000.0, 7000.0), (3, '>7k', 7000.0, 'inf'::DOUBLE)) t(ord, band, lo, hi)",
    "cell_band": "SELECT y, x, band FROM cells JOIN bands ON elev >= lo AND elev < hi UNION ALL SELECT y, x, 'total' FROM cells",
    "days": "SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM obs",
    "full_obs": "SELECT s.basin, s.station, d.date, o.value FROM (SELECT DISTINCT basin, station FROM obs) s CROSS JOIN days d LEFT JOIN obs o USING (basin, station, date)",
}


def with_views(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names) + " "


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query; ``sql`` goes after the views' common table expressions (starting with a comma if it adds its own)."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = (with_views(*views) if views else "") + sql
        return f

    return add
