"""Alerts on event volumes that leave their exponentially weighted mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.schemas import ALPHA, THRESHOLD_K, WARMUP

ALERTS = "array<struct<bucket: timestamp, observed: bigint, baseline_mean: double, baseline_stddev: double, z_score: double, baseline_samples: bigint>>"


def _start(state: Column | None, kind: str) -> Column:
    empty = F.lit(None).cast(ALERTS.replace("timestamp", kind))
    none = F.coalesce(empty, F.array().cast(ALERTS.replace("timestamp", kind)))
    part = lambda name, zero: F.coalesce(state[name], zero) if state is not None else zero
    return F.struct(part("mean", F.lit(0.0)).alias("mean"), part("var", F.lit(0.0)).alias("var"), part("n", F.lit(0).cast("long")).alias("n"), none.alias("alerts"))


def _step(alpha: float, k: float, warmup: int):
    """One bucket: scored against the baseline before it, then taken into the baseline, alerting or not. The first only seeds it."""

    def merge(s: Column, x: Column) -> Column:
        seen = x["observed"].cast("double")
        sd = F.greatest(F.sqrt(s["var"]), F.sqrt(F.greatest(s["mean"], F.lit(1.0))))
        z = (seen - s["mean"]) / sd
        alert = (s["n"] >= warmup) & (F.abs(z) >= k)
        row = F.struct(x["bucket"].alias("bucket"), x["observed"].alias("observed"), s["mean"].alias("baseline_mean"), sd.alias("baseline_stddev"), z.alias("z_score"), s["n"].alias("baseline_samples"))
        d = seen - s["mean"]
        first = s["n"] == 0
        return F.struct(
            F.when(first, seen).otherwise(s["mean"] + alpha * d).alias("mean"),
            F.when(first, F.lit(0.0)).otherwise((1 - alpha) * (s["var"] + alpha * d * d)).alias("var"),
            (s["n"] + 1).alias("n"),
            F.when(alert, F.concat(s["alerts"], F.array(row))).otherwise(s["alerts"]).alias("alerts"),
        )

    return merge


def fold(volume: DataFrame, alpha: float = ALPHA, k: float = THRESHOLD_K, warmup: int = WARMUP, keys: tuple[str, ...] = (), state: DataFrame | None = None) -> DataFrame:
    """(keys, s): for each series its baseline (mean, var, n) after all of ``volume``(keys, bucket, observed), and the alerts on the way.

    state(keys, mean, var, n) is where series begin that were seen before. Order matters, so a series is folded in one row; its input is a row
    for each bucket, a few bytes a minute, however many events lie behind it.
    """
    kind = dict(volume.dtypes)["bucket"]
    series = volume.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("bucket", "observed"))).alias("b"))
    begin = _start(None, kind)
    if state is not None:
        state = state.select(*[F.col(c).alias(f"s_{c}") for c in keys], F.struct("mean", "var", "n").alias("st"))
        on = [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in keys]
        series = series.join(state, on or F.lit(True), "left")
        begin = _start(F.col("st"), kind)
    return series.where(F.size("b") > 0).select(*keys, F.aggregate("b", begin, _step(alpha, k, warmup)).alias("s"))


def alerts_of(folded: DataFrame, k: float = THRESHOLD_K, keys: tuple[str, ...] = ()) -> DataFrame:
    a = folded.select(*keys, F.explode("s.alerts").alias("a"))
    way = F.when(F.col("a.observed") >= F.col("a.baseline_mean"), F.lit("spike")).otherwise(F.lit("drop"))
    return a.select(*keys, F.col("a.bucket").alias("alert_time"), F.col("a.observed").alias("observed"), F.col("a.baseline_mean").alias("baseline_mean"), F.col("a.baseline_stddev").alias("baseline_stddev"), F.col("a.z_score").alias("z_score"), F.lit(float(k)).alias("threshold_k"), way.alias("direction"), F.col("a.baseline_samples").alias("baseline_samples"))


def ewma_alerts(volume: DataFrame, alpha: float = ALPHA, k: float = THRESHOLD_K, warmup: int = WARMUP, keys: tuple[str, ...] = ()) -> DataFrame:
    """A row for each bucket that lies ``k`` deviations or more from the mean of those before it, once ``warmup`` buckets are known."""
    return alerts_of(fold(volume, alpha, k, warmup, keys), k, keys)
