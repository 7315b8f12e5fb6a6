"""Quality control of daily station values: hard checks, peer residuals, peer votes, model intervals, majority.

All days are scored in one job: what depends on the history alone (bounds, pair models, spreads) is one small table
that joins the days.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.operators import peers as P
from fieldspark.operators.calendars import KEYS, daily_calendar
from fieldspark.operators.models import fit_ols, interval_score
from fieldspark.operators.sequences import long_runs, null_to_value, row_difference, with_gate
from fieldspark.sources.tables import small_side, written

#: Reasons that are a method's own signal and not a hard check.
OWN_SIGNALS = ("PEER_RESID", "VOTING", "PRED_RESID")


def threshold(sigma: Column, level: Column, sigmas: float = 3.0, buffer: float = 1.2, floor: float = 25.0, share: float = 0.05) -> Column:
    """max(sigmas * sigma * buffer, floor, share * max(|level|, 1))."""
    return F.greatest(sigmas * sigma * buffer, F.lit(floor), share * F.greatest(F.abs(level), F.lit(1.0)))


def graded(df: DataFrame, method: str, checks: Sequence[tuple[str, Column, int]], skipped: Column | None = None) -> DataFrame:
    """Adds method, reason_code, severity and flag: the first check that holds decides (Q4)."""
    reason = reduce(lambda done, c: done.when(F.coalesce(c[1], F.lit(False)), c[0]), checks, F.when(F.lit(False), F.lit("")))
    if skipped is not None:
        reason = reason.when(skipped, "SKIPPED")
    severity = F.coalesce(F.create_map(*[F.lit(x) for name, _, s in checks for x in (name, s)])[F.col("reason_code")], F.lit(0))
    df = df.withColumns({"method": F.lit(method), "reason_code": reason.otherwise("OK")}).withColumn("severity", severity)
    return df.withColumn("flag", (F.col("severity") > 0).cast("int"))


def reason_text(value: Column, expected: Column, limit: Column) -> Column:
    """A readable reason of a row (Q4)."""
    numbers = F.format_string("%s: value %.1f, expected %.1f, limit %.1f", F.col("reason_code"), value, expected, limit)
    return F.when(F.col("reason_code").isin(*OWN_SIGNALS), numbers).otherwise(F.col("reason_code"))


def own_signal(flag: Column) -> Column:
    """The flag only where the method's own signal raised it (Q4)."""
    return F.when(F.col("reason_code").isin(*OWN_SIGNALS), flag).otherwise(0)


def with_steps(test: DataFrame, value: str = "value") -> DataFrame:
    """Adds delta to the previous row (zero on the first) and appeared (null, then a value)."""
    return test.withColumns({"delta": row_difference(F.col(value), first_is_zero=True), "appeared": null_to_value(F.col(value))})


def hard_checks(low: float = 0.0, high: float = 3000.0, value: str = "value") -> list[tuple[str, Column, int]]:
    v = F.col(value)
    return [("MISSING", v.isNull(), 2), ("PHYSICAL", (v < low) | (v > high), 2)]


def envelope(history: DataFrame, q_lo: float = 0.005, q_hi: float = 0.995, value: str = "value") -> DataFrame:
    """Bounds of each station's daily change over its history (A10)."""
    return P.quantile_bounds(history.withColumn("__d", row_difference(F.col(value))), KEYS, "__d", q_lo, q_hi)


def static_qa(
    history: DataFrame, test: DataFrame, ranked: DataFrame, gate: float | None = None, q_lo: float = 0.005, q_hi: float = 0.995, buffer: float = 1.5, k: int = 5, high: float = 3000.0
) -> DataFrame:
    """Hard checks, change envelope and peer residual (Q1), one row a (basin, station, date) of ``test``.

    Order: missing (2), out of [0, ``high``] (2), appeared (1), change outside the buffered quantile bounds (2), peer
    residual (1). The peer spread is the robust sigma of the history's differences from the daily median of today's
    peers, computed once for each distinct set of peers. Below the gate, without peers or spread the last is skipped.
    """
    bounds = small_side(written(envelope(history, q_lo, q_hi), "qa-bounds"))
    today = written(P.peer_median(test, ranked, k), "qa-today")
    sets = today.select("basin", "station", "peer_set").distinct()
    member = sets.withColumn("peer", F.explode("peer_set"))
    other = history.where("value IS NOT NULL").select("basin", F.col("station").alias("peer"), "date", F.col("value").alias("pv"))
    middle = member.join(other, ["basin", "peer"]).groupBy("basin", "station", "peer_set", "date").agg(F.median("pv").alias("m"))
    resid = middle.join(history, ["basin", "station", "date"]).where("value IS NOT NULL").withColumn("resid", F.col("value") - F.col("m"))
    resid = written(resid.select("basin", "station", "peer_set", "resid"), "qa-resid")  # its median and then its spread
    sigma = P.robust_sigma(resid, ["basin", "station", "peer_set"], "resid", 5, True).select("basin", "station", "peer_set", "sigma")
    rows = with_steps(test).join(bounds, list(KEYS), "left").join(today, ["basin", "station", "date"], "left").join(sigma, ["basin", "station", "peer_set"], "left")
    v, m = F.col("value"), F.col("peer_median")
    rows = rows.withColumn("limit", threshold(F.col("sigma"), m))
    low = F.lit(False) if gate is None else (v < gate) | (m < gate)
    skipped = F.coalesce(low, F.lit(True)) | m.isNull() | F.col("sigma").isNull()
    checks = [
        *hard_checks(high=high),
        ("APPEARED", F.col("appeared"), 1),
        ("DELTA", (F.col("delta") < F.col("lo") * buffer) | (F.col("delta") > F.col("hi") * buffer), 2),
        ("PEER_RESID", ~skipped & (F.abs(v - m) > F.col("limit")), 1),
    ]
    return graded(rows, "static", checks, skipped).drop("peer_set")


def pair_fits(steps: DataFrame, ranked: DataFrame, min_fit: int = 40, fitted: bool = False) -> DataFrame:
    """Regression of the change ``d`` on the peer's change, its weight and the peer's rank.

    ``fitted``: ``ranked`` already has the regressions of these steps (``peers.pair_stats``).
    """
    keys = ["basin", "station", "peer"]
    if fitted:
        fits = ranked.where(F.col("n") >= min_fit)
    else:
        fits = P.pair_stats(steps, "d", min_fit).join(ranked.select(*keys, "rk"), keys)
    return fits.select(*keys, "slope", "intercept", F.coalesce(F.col("score"), F.lit(0.5)).alias("weight"), "rk")


def pair_spreads(steps: DataFrame, fits: DataFrame, min_n: int = 10) -> DataFrame:
    """``fits`` with ``sigma``, the robust spread of their residuals over ``steps`` (A9). Only these pairs' days are joined."""
    pair = ["basin", "station", "peer"]
    own = small_side(fits.select(*pair, "slope", "intercept"))
    known = steps.where("d IS NOT NULL")
    resid = known.select("basin", "station", "date", F.col("d").alias("y")).join(own, ["basin", "station"])
    resid = resid.join(known.select("basin", F.col("station").alias("peer"), "date", F.col("d").alias("x")), ["basin", "peer", "date"])
    resid = written(resid.select(*pair, (F.col("y") - F.col("intercept") - F.col("slope") * F.col("x")).alias("e")), "qa-resid")
    return fits.join(P.robust_sigma(resid, pair, "e", min_n, False).select(*pair, "sigma"), pair)


def voting_qa(history: DataFrame, test: DataFrame, ranked: DataFrame, k: int = 5, min_fit: int = 40, min_votes: int = 3, least_ok: float = 0.6, gate: float = 50.0, high: float = 3000.0, fitted: bool = False) -> DataFrame:
    """Votes of the best ranked peers that have a change today (Q2), one row a (basin, station, date) of ``test``.

    A peer votes ok if the change is within the threshold of what its regression expects; the worst votes are
    trimmed; the day is flagged if the ok weight is below ``least_ok``, unless today and yesterday are below the gate.
    ``fitted``: ``ranked`` has the regressions of the history's changes (it comes from ``peers.pair_stats`` of these).
    """
    past = written(history.withColumn("d", row_difference(F.col("value"))).select("basin", "station", "date", "d"), "qa-steps")
    fits = pair_fits(past, ranked, min_fit, fitted)
    fits = fits if fitted else written(fits, "qa-fits")
    steps = written(with_steps(test), "qa-days")
    votes = written(P.peers_today(steps, fits, k, rank_first=False, value="delta").drop("rk"), "qa-votes")
    able = votes.select("basin", "station", "peer").distinct()
    models = written(pair_spreads(past, fits.join(able, ["basin", "station", "peer"], "left_semi")), "qa-models")
    votes = votes.join(small_side(models.drop("rk")), ["basin", "station", "peer"])
    votes = votes.join(steps.select("basin", "station", "date", "delta"), ["basin", "station", "date"]).where("delta IS NOT NULL AND sigma IS NOT NULL")
    votes = votes.withColumn("expected", F.col("intercept") + F.col("slope") * F.col("peer_value")).withColumn("miss", F.abs(F.col("delta") - F.col("expected")))
    votes = votes.withColumn("ok", F.col("miss") <= threshold(F.col("sigma"), F.col("expected")))
    days = ["basin", "station", "date"]
    tally = P.ok_fraction(P.trim_worst(votes, days, F.col("miss")), days).where(F.col("votes") >= min_votes)
    rows = steps.join(tally, days, "left")
    v = F.col("value")
    small = (v < gate) & (v - F.col("delta") < gate)
    skipped = F.col("ok_fraction").isNull() | F.coalesce(small, F.lit(False))
    return graded(rows, "voting", [*hard_checks(high=high), ("VOTING", ~skipped & (F.col("ok_fraction") < least_ok), 1)], skipped)


def model_qa(
    history: DataFrame, test: DataFrame, predictors: Sequence[str], method: str = "base", min_fit: int = 60, gate: float = 50.0, eps: float = 0.0, high: float = 3000.0
) -> DataFrame:
    """Interval of a regression on grid predictors (Q3), one row a (basin, station, date) of ``test``.

    Methods: ``base``; ``seasonal`` adds the water day's sine and cosine where the predictors rise over the last
    rows (else base); ``detrend`` centres by the means, which gives base's prediction.
    """
    from fieldspark.functions.units import season_angle

    xs = list(predictors)
    if method == "seasonal":
        sin, cos = season_angle(F.col("date"))
        history, test = (d.withColumns({"w_sin": sin, "w_cos": cos}) for d in (history, test))
    rows = interval_score(test, fit_ols(history, KEYS, "value", xs, min_fit), KEYS, xs)
    if method == "seasonal":
        wide = interval_score(test, fit_ols(history, KEYS, "value", [*xs, "w_sin", "w_cos"], min_fit), KEYS, [*xs, "w_sin", "w_cos"])
        wide = wide.select("basin", "station", "date", F.col("pred").alias("__p"), F.col("se").alias("__s"))
        rows = with_gate(rows.join(wide, ["basin", "station", "date"], "left"), xs, 3, eps)
        use = F.col("gate") & F.col("__p").isNotNull()
        rows = rows.withColumns({"pred": F.when(use, F.col("__p")).otherwise(F.col("pred")), "se": F.when(use, F.col("__s")).otherwise(F.col("se"))}).drop("__p", "__s", "gate")
    rows = rows.withColumn("pred", F.when(F.col("pred").isNotNull(), F.greatest("pred", F.lit(0.0))))
    v, p = F.col("value"), F.col("pred")
    rows = rows.withColumn("limit", threshold(F.col("se"), p, 2.0))
    skipped = p.isNull() | F.col("se").isNull() | (p < gate)
    return graded(rows, "model", [*hard_checks(high=high), ("PRED_RESID", ~skipped & (F.abs(v - p) > F.col("limit")), 1)], skipped)


SIMPLE = ("basin", "station", "date", "method", "flag", "reason_code", "severity")


def run_qa(history: DataFrame, test: DataFrame, ranked: DataFrame, predictors: Sequence[str] = (), method: str = "base") -> DataFrame:
    """All methods over all days as one long table (Q5); the static gate is off, the others stand at 50 (fixed values)."""
    parts = [static_qa(history, test, ranked, gate=None), voting_qa(history, test, ranked)]
    if predictors:
        parts.append(model_qa(history, test, predictors, method))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.select(*SIMPLE) for p in parts])


def majority(flags: DataFrame, methods: Sequence[str] = ("static", "voting", "model"), require_all: bool = False, least: int = 2) -> DataFrame:
    """(basin, station, date, <methods>, majority): at least ``least`` methods flag; missing methods count 0 or void the row."""
    wide = flags.groupBy(*KEYS, "date").pivot("method", list(methods)).agg(F.max("flag"))
    wide = wide.dropna(subset=list(methods)) if require_all else wide.na.fill(0, list(methods))
    return wide.withColumn("majority", (sum((F.col(m) for m in methods), F.lit(0)) >= least).cast("int"))


def mask_persistent(values: DataFrame, flags: DataFrame, min_run: int = 3, manual_only: bool = False, value: str = "value", methods: Sequence[str] = ("static", "voting", "model")) -> DataFrame:
    """Values with majority runs of at least ``min_run`` days set to null; adds ``masked`` (Q6).

    Days without flags count as not flagged. ``manual_only`` leaves the values alone and only reports (Q7).
    """
    days = daily_calendar(values).join(majority(flags, methods).select(*KEYS, "date", "majority"), [*KEYS, "date"], "left").na.fill(0, ["majority"])
    days = long_runs(days, "majority", min_run, alias="masked")
    return days if manual_only else days.withColumn(value, F.when(F.col("masked") == 0, F.col(value)))
