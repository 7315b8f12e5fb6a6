"""Gaps filled from peer stations (M2), on sufficient statistics by availability pattern.

Days on which the same stations report share a pattern. A pattern's days enter every regression together or not at all,
so they are kept as the triangular factor R of [1, values]: R'R is their Gram matrix, and R never has more rows than
the days or than the columns. The history is read once for this. The Gram matrix of any target, chosen peers and
candidate is that of all rows whose patterns hold these stations: sums over the patterns' supersets, taken for all
candidates at once by products with the patterns' masks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.linear import adjusted, solve
from fieldspark.sources.tables import small_side, written

KEYS = ("basin", "station")
#: Numbers that a task holds before it hands its patterns on, target stations of a task, patterns up to which their models are broadcast.
HELD, TARGETS, FEW_PATTERNS = 2_000_000, 8, 20_000


def station_values(df: DataFrame, value: str) -> DataFrame:
    """(basin, date, m): a day's values by station; of repeated rows the least value."""
    one = df.where(F.col(value).isNotNull()).groupBy("basin", "station", "date").agg(F.min(F.col(value).cast("double")).alias("v"))
    return one.groupBy("basin", "date").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("station", "v")))).alias("m"))  # a basin's stations


def triangle(rows: np.ndarray) -> np.ndarray:
    """The rows, or their triangular factor if that has fewer."""
    return np.linalg.qr(rows, mode="r") if len(rows) > rows.shape[1] else rows


def pattern_factors(days: DataFrame, since: str) -> DataFrame:
    """(basin, late, stations, row): the factor rows of each pattern of ``days`` (basin, date, m), those from ``since`` on apart."""
    kinds = dict(days.select("basin", F.map_keys("m").alias("stations")).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[np.ndarray]] = {}
        size = 0

        def give() -> pa.RecordBatch:
            out = [(*key, row) for key, parts in held.items() for row in triangle(np.vstack(parts))]
            held.clear()
            basin, late, stations, row = zip(*out, strict=True) if out else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(basin, kind_of[0]), pa.array(late, pa.bool_()), pa.array(map(list, stations), kind_of[1]), pa.array(row, pa.list_(pa.float64()))], names=["basin", "late", "stations", "row"])

        kind_of: list[pa.DataType] = []
        for batch in batches:
            kind_of = [batch.schema.field("basin").type, batch.schema.field("stations").type]
            for basin, late, stations, values in zip(*(batch.column(c).to_pylist() for c in ("basin", "late", "stations", "row")), strict=True):
                parts = held.setdefault((basin, late, tuple(stations)), [])
                parts.append(np.array([[1.0, *values]]))
                size += len(values) + 1
                if len(parts) > 2 * len(values) + 50:
                    size -= sum(map(np.size, parts))
                    parts[:] = [triangle(np.vstack(parts))]
                    size += parts[0].size
            if size > HELD:
                yield give()
                size = 0
        if held:
            yield give()

    rows = days.select("basin", (F.col("date") >= F.lit(since).cast("date")).alias("late"), F.map_keys("m").alias("stations"), F.map_values("m").alias("row"))
    return rows.mapInArrow(run, f"basin {kinds['basin']}, late boolean, stations {kinds['stations']}, row array<double>")


class History:
    """A basin's factor rows as one matrix, from which all moments follow."""

    def __init__(self, late: np.ndarray, stations: list, rows: list):
        self.names = sorted({s for own in stations for s in own})
        at = {s: i for i, s in enumerate(self.names)}
        self.late, self.at = late, at
        self.ones, self.x, self.known = np.zeros(len(rows)), np.zeros((len(rows), len(at))), np.zeros((len(rows), len(at)), bool)
        for i, (own, row) in enumerate(zip(stations, rows, strict=True)):
            columns = [at[s] for s in own]
            self.ones[i], self.x[i, columns], self.known[i, columns] = row[0], row[1:], True
        weight = (self.ones**2) @ self.known
        self.level = (self.ones @ self.x) / np.where(weight > 0, weight, 1)
        self.x -= self.known * self.ones[:, None] * self.level  # less each station's mean, so that no digits are lost
        self.found: dict[tuple, dict[int, float]] = {}

    def moments(self, columns: list[int], late_only: bool) -> tuple[int, np.ndarray, np.ndarray]:
        """(n, mean, cov) of the rows that have all ``columns``."""
        rows = self.known[:, columns].all(axis=1) & (self.late if late_only else True)
        a = np.column_stack([self.ones[rows], self.x[np.ix_(rows, columns)]])
        gram = a.T @ a
        n = int(np.rint(gram[0, 0]))
        mean = gram[0, 1:] / max(n, 1)
        return n, mean, gram[1:, 1:] / max(n, 1) - np.outer(mean, mean)

    def scores(self, target: int, chosen: tuple[int, ...], first_peer_score: bool) -> dict[int, float]:
        """Adjusted r² with each further peer: over all rows for the first peer, over late ones for others."""
        if (key := (target, chosen)) in self.found:
            return self.found[key]
        own = [target, *chosen]
        rows = self.known[:, own].all(axis=1) & (self.late if chosen else True)
        a, x, known = np.column_stack([self.ones[rows], self.x[np.ix_(rows, own)]]), self.x[rows], self.known[rows].astype(float)
        q = a.shape[1]
        gram = ((a[:, :, None] * a[:, None, :]).reshape(len(a), q * q).T @ known).reshape(q, q, -1)  # of target and chosen, by peer
        cross, square = a.T @ x, (x * x).sum(axis=0)
        out = self.found[key] = {}
        for p in range(len(self.names)):
            n = int(np.rint(gram[0, 0, p]))
            if p in own or n <= len(chosen) + 2:
                continue
            full = np.block([[gram[:, :, p], cross[:, p : p + 1]], [cross[:, p : p + 1].T, square[p]]])
            mean = full[0, 1:] / n
            cov = full[1:, 1:] / n - np.outer(mean, mean)
            if cov[0, 0] <= 0:
                r2 = 0.0
            elif first_peer_score or not chosen:
                r2 = cov[0, 1] ** 2 / (cov[0, 0] * cov[1, 1]) if cov[1, 1] > 0 else 0.0
            else:
                r2 = float(solve(n, mean, cov)[1] @ cov[1:, 0]) / cov[0, 0]
            out[p] = round(adjusted(min(1.0, max(0.0, r2)), n, len(own)), 10)
        return out

    def choose(self, target, valid: list, most: int, first_peer_score: bool) -> list:
        """Up to ``most`` valid peers, added while the score rises; of equal scores the first valid one."""
        if target not in self.at:
            return []
        chosen, best = [], -np.inf
        able = [self.at[s] for s in valid if s in self.at]
        for _ in range(most):
            scores = self.scores(self.at[target], tuple(chosen), first_peer_score)
            top = max((p for p in able if p in scores), key=lambda p: scores[p], default=None)
            if top is None or not scores[top] > best:
                break
            best, chosen = scores[top], [*chosen, top]
        return chosen

    def fit(self, target, chosen: list[int]) -> tuple[float, list[float]] | None:
        """(intercept, beta) over the late rows that have all, of which there are two at least."""
        n, mean, cov = self.moments([self.at[target], *chosen], True)
        if n < 2:
            return None
        own, levels = self.level[self.at[target]], self.level[chosen]
        intercept, beta, _, _ = solve(n, mean, cov)
        return float(intercept + own - beta @ levels), beta.tolist()


def peer_models(keys: DataFrame, factors: DataFrame, most: int = 3, first_peer_score: bool = False) -> DataFrame:
    """``keys`` (basin, station, valid) with ``chosen``, ``intercept`` and ``beta``, where peers are found.

    A task has up to about ``TARGETS`` stations of a basin and the basin's factors; (target, chosen) is scored once
    however many sets of valid peers ask for it.
    """
    parts = keys.groupBy("basin").agg(F.ceil(F.count_distinct("station") / TARGETS).cast("int").alias("parts"))
    parts = small_side(written(parts, "gap-parts"))
    mine = keys.join(parts, "basin").withColumn("part", F.pmod(F.xxhash64("station"), F.col("parts")).cast("int")).drop("parts")
    spread = factors.join(parts, "basin").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    kinds = dict(keys.dtypes)
    names = [*KEYS, "valid", "chosen", "intercept", "beta"]

    def run(want: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(want) and len(rows):
            past = History(rows["late"].to_numpy(bool), rows["stations"].tolist(), rows["row"].tolist())
            for basin, station, valid in zip(want["basin"], want["station"], want["valid"], strict=True):
                chosen = past.choose(station, list(valid), most, first_peer_score)
                fit = past.fit(station, chosen) if chosen else None
                if fit:
                    out.append((basin, station, valid, [past.names[p] for p in chosen], *fit))
        return pd.DataFrame(out, columns=names)

    schema = f"basin {kinds['basin']}, station {kinds['station']}, valid {kinds['valid']}, chosen {kinds['valid']}, intercept double, beta array<double>"
    return mine.groupBy("basin", "part").cogroup(spread.groupBy("basin", "part")).applyInPandas(run, schema)


def impute_from_peers(rows: DataFrame, history: DataFrame, since: str = "2013-01-01", first_peer_score: bool = False, value: str = "value") -> DataFrame:
    """Missing values of (basin, station, date) rows from up to three peers that are valid that day (M2).

    Stations take their turn by id, and a filled value is a valid peer for later stations; a day without any value
    stays as it is. The first peer is scored over all of the history, later ones and the fit from ``since`` on; with
    ``first_peer_score`` later ones by the correlation with the first peer alone, on the days that the candidate has.
    Days with the same present and missing stations share their models; a day's gaps are filled in one ordered pass.
    Clipped at zero. Adds ``imputed``.
    """
    gaps = rows.where(F.col(value).isNull()).groupBy("basin", "date").agg(F.sort_array(F.collect_set("station")).alias("missing"))
    days = gaps.join(station_values(rows, value), ["basin", "date"]).withColumn("present", F.map_keys("m"))
    days = written(days, "gap-days")
    pattern = ["basin", "present", "missing"]
    valid = F.sort_array(F.concat("present", F.filter("missing", lambda s: s < F.col("station"))))
    wanted = written(days.select(*pattern).distinct().withColumn("station", F.explode("missing")).withColumn("valid", valid), "gap-wanted")
    factors = written(pattern_factors(station_values(history, value), since), "gap-factors")
    models = written(peer_models(wanted.select(*KEYS, "valid").distinct(), factors, 3, first_peer_score), "gap-models")
    plan = wanted.join(models, [*KEYS, "valid"]).groupBy(*pattern).agg(F.sort_array(F.collect_list(F.struct("station", "chosen", "intercept", "beta"))).alias("gaps"))
    plan = written(plan, "gap-plan")

    def fill(m: Column, gap: Column) -> Column:
        terms = F.zip_with(gap["chosen"], gap["beta"], lambda peer, b: F.try_element_at(m, peer) * b)
        p = F.aggregate(terms, gap["intercept"], lambda a, t: a + t)
        return F.when(p.isNotNull(), F.map_concat(m, F.create_map(gap["station"], F.greatest(p, F.lit(0.0))))).otherwise(m)

    todo = days.join(F.broadcast(plan) if plan.count() <= FEW_PATTERNS else plan, pattern)
    kind = dict(rows.dtypes)["station"]
    done = todo.select("basin", "date", "gaps", F.aggregate("gaps", F.col("m").cast(f"map<{kind},double>"), fill).alias("m"))
    found = done.select("basin", "date", "m", F.explode("gaps.station").alias("station")).select(*KEYS, "date", F.try_element_at("m", F.col("station")).alias("__f"))
    out = rows.join(found, [*KEYS, "date"], "left")
    return out.withColumn("imputed", F.col(value).isNull() & F.col("__f").isNotNull()).withColumn(value, F.coalesce(value, "__f")).drop("__f")
