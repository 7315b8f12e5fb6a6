"""Forward selection by held-out years on Gram matrices (M5, M6, M7).

A year's surveys enter training or are held out together, so a year is kept as the Gram matrix of [1, y, x]. Matrices
add up: the training rows of a fold are the total less its year, those of a back-test the running sum over earlier
water years, and a set of stations is a choice of rows and columns. No survey is copied for a fold, a set or a year.

An ask says what to train in a group: (by, ask, use, before, without). ``use`` are the positions in x that may be chosen
(null: all); surveys count from water years before ``before`` and other than ``without`` (null: all of them).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.units import water_year

#: The columns of an ask that say which surveys count.
SPAN = ("before", "without")
#: Asks of a group that one task answers.
ASKS = 16
#: A station counts as dependent on the chosen ones below this share of its variance.
DEPENDENT = 1e-10


def with_years(table: DataFrame) -> DataFrame:
    """``table`` with ``fold``, its calendar year, and ``wy``, its water year."""
    return table.withColumns({"fold": F.year("date"), "wy": water_year(F.col("date")).cast("int")})


def survey_grams(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, wy, fold, gram): the Gram matrix of [1, y, x] of each year's surveys; missing predictors count as zero."""
    keys = [*by, "wy", "fold"]
    kinds = dict(table.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; a key's matrix grows until the next key."""
        key, gram = None, None
        for batch in batches:
            done: list[tuple] = []
            own = list(zip(*(batch.column(c).to_pylist() for c in keys), strict=True))
            y, x = batch.column("y").to_pylist(), batch.column("x").to_pylist()
            cuts = [0, *[i for i in range(1, len(own)) if own[i] != own[i - 1]], len(own)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                a = np.column_stack([np.ones(e - s), np.array(y[s:e], float), np.nan_to_num(np.array(x[s:e], float).reshape(e - s, -1))])
                if own[s] != key:
                    done += [(key, gram)] if key is not None else []
                    key, gram = own[s], a.T @ a
                else:
                    gram = gram + a.T @ a
            if done:
                yield packed(done, batch.schema)
        if key is not None:
            yield packed([(key, gram)], batch.schema)

    def packed(done: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k, _ in done], schema.field(c).type) for i, c in enumerate(keys)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([g.ravel() for _, g in done], pa.list_(pa.float64()))], names=[*keys, "gram"])

    rows = with_years(table.where("y IS NOT NULL")).select(*keys, "y", "x").repartition(*keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in by) + ", wy int, fold int, gram array<double>")


def one_ask(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """All stations and all surveys of each group."""
    none = F.lit(None)
    return table.select(*by).distinct().select(*by, F.lit("").alias("ask"), none.cast("array<int>").alias("use"), *[none.cast("int").alias(c) for c in SPAN])


def in_span(wy: np.ndarray, before, without) -> np.ndarray:
    """Which water years count; nan and None set no bound."""
    ok = np.ones(len(wy), bool) if pd.isna(before) else np.asarray(wy) < before
    return ok if pd.isna(without) else ok & (np.asarray(wy) != without)


def step_scores(s: np.ndarray, chosen: list[int], rest: list[int]) -> np.ndarray:
    """r² of the fits on ``chosen`` and each of ``rest``; s is the centred cross-product matrix with y first."""
    if s[0, 0] <= 0:
        return np.zeros(len(rest))
    own, left, base = s[np.ix_(rest, chosen)], s[rest, 0], s[rest, rest]
    known = s[chosen, 0]
    p = np.linalg.pinv(s[np.ix_(chosen, chosen)], rcond=1e-12, hermitian=True) if chosen else np.zeros((0, 0))
    r = own @ p
    free = base - (r * own).sum(axis=1)
    more = np.where(free > DEPENDENT * base, (left - r @ known) ** 2 / np.where(free > 0, free, 1), 0.0)
    return np.round((known @ p @ known + more) / s[0, 0], 12)


def grow(train: np.ndarray, held: np.ndarray, use: Sequence[int], most: int | None = None) -> tuple[list[int], float, np.ndarray]:
    """(chosen, intercept, beta): stations added by r² while the held-out RMSE doesn't rise and fewer than n - 1 are used (M5, M6).

    Both matrices are of [1, y, x]; of equal scores the lowest position wins. The held-out surveys steer the choice, as
    in the original procedure, so its validation is optimistic.
    """
    n = train[0, 0]
    chosen, fit, best = [], (0.0, np.zeros(0)), np.inf
    if n < 0.5:
        return chosen, *fit
    mean = train[0, 1:] / n
    s = train[1:, 1:] - np.outer(train[0, 1:], mean)
    most = int(round(n)) - 1 if most is None else most
    at: list[int] = []  # positions in s: y is 0
    while len(at) < most:
        rest = [i + 1 for i in use if i + 1 not in at]
        if not rest:
            break
        new = [*at, rest[int(np.argmax(step_scores(s, at, rest)))]]
        beta = np.linalg.pinv(s[np.ix_(new, new)], rcond=1e-12, hermitian=True) @ s[new, 0]
        v = np.zeros(len(train))
        v[0], v[1] = mean[0] - beta @ mean[new], -1.0
        v[[i + 1 for i in new]] = beta
        error = np.sqrt(max(0.0, v @ held @ v) / held[0, 0])
        if error > best * (1 + 1e-10):
            break
        at, best, fit = new, error, (float(v[0]), beta)
    return [i - 1 for i in at], *fit


class Years:
    """A group's years in standard units, with the sums that asks share."""

    def __init__(self, wy: np.ndarray, fold: np.ndarray, grams: list):
        size = int(np.sqrt(len(grams[0])))
        g = np.array(grams, float).reshape(-1, size, size)
        total = g.sum(axis=0)
        n = total[0, 0]
        self.mean = total[0, 1:] / n
        spread = np.sqrt(np.maximum(total.diagonal()[1:] / n - self.mean**2, 0))
        self.scale = np.where(spread > 1e-12 * np.abs(self.mean), spread, 1.0)
        turn = np.eye(size)
        turn[0, 1:] = -self.mean / self.scale
        turn[range(1, size), range(1, size)] = 1 / self.scale
        self.g, self.wy, self.fold, self.sums = turn.T @ g @ turn, wy, fold, {}

    def of(self, before: int | None, without: int | None) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """(sum of all years, sum of each fold) of the water years that count."""
        if (key := (before, without)) not in self.sums:
            ok = in_span(self.wy, before, without)
            folds = {int(f): self.g[ok & (self.fold == f)].sum(axis=0) for f in np.unique(self.fold[ok])}
            self.sums[key] = (sum(folds.values()), folds)
        return self.sums[key]

    def fits(self, use: list[int] | None, span: tuple[int | None, int | None], most: int | None) -> list[tuple[int, list[int], float, list[float]]]:
        """(fold, chosen, intercept, beta) of each fold, in the surveys' units."""
        total, folds = self.of(*span)
        out = []
        for f, held in folds.items():
            train = total - held if len(folds) > 1 else held * 0
            chosen, intercept, beta = grow(train, held, range(len(self.mean) - 1) if use is None else use, most)
            at = [i + 1 for i in chosen]
            beta = beta * self.scale[0] / self.scale[at]
            out.append((f, chosen, float(intercept * self.scale[0] + self.mean[0] - beta @ self.mean[at]) if chosen else 0.0, beta.tolist()))
        return out


def fold_fits(grams: DataFrame, asks: DataFrame, by: Sequence[str], most: int | None = None) -> DataFrame:
    """(by, ask, before, without, fold, features, intercept, beta): what each fold of each ask selects and fits without its year.

    A row that a task solves has the years of a group and up to about ``ASKS`` asks.
    """
    n = F.ceil(F.count("*").over(Window.partitionBy(*by)) / ASKS).cast("int")
    asked = asks.withColumn("part", F.pmod(F.xxhash64("ask"), n)).groupBy(*by, "part").agg(F.collect_list(F.struct("ask", "use", *SPAN)).alias("asks"))
    years = grams.groupBy(*by).agg(F.collect_list(F.struct("wy", "fold", "gram")).alias("years"))  # a group's years
    work = asked.join(years, list(by)).drop("part").repartition(*by, F.xxhash64("asks.ask"))
    kinds = dict(grams.dtypes)
    names = [*by, "ask", *SPAN, "fold", "features", "intercept", "beta"]
    types = [pa.string(), *[pa.int32()] * 3, pa.list_(pa.int32()), pa.float64(), pa.list_(pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                group = Years(*(np.array([y[c] for y in one["years"]]) for c in ("wy", "fold")), [y["gram"] for y in one["years"]])
                out = [(*(one[c] for c in by), a["ask"], *(a[c] for c in SPAN), *fit) for a in one["asks"] for fit in group.fits(a["use"], tuple(a[c] for c in SPAN), most)]
                if out:
                    kind = [*(batch.schema.field(c).type for c in by), *types]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out, strict=True), kind, strict=True)], names=names)

    schema = ", ".join(f"{c} {kinds[c]}" for c in by) + ", ask string, before int, without int, fold int, features array<int>, intercept double, beta array<double>"
    return work.mapInArrow(run, schema)


def held_out(table: DataFrame, fits: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, ask, fold, date, y, pred, features): every survey predicted without its year, clipped at zero (M7)."""
    rows = with_years(table.where("y IS NOT NULL")).join(fits, [*by, "fold"]).where("(before IS NULL OR wy < before) AND (without IS NULL OR wy <> without)")
    terms = F.zip_with("features", "beta", lambda f, b: F.coalesce(F.get("x", f), F.lit(0.0)) * b)
    pred = F.greatest(F.aggregate(terms, F.col("intercept"), lambda a, t: a + t), F.lit(0.0))
    return rows.select(*by, "ask", "fold", "date", "y", pred.alias("pred"), "features")
