"""Rollups as they are shown: renamed, ranked and cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _camel(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(x.title() for x in rest)


def _camelled(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).alias(_camel(c)) for c in df.columns])


def metrics_view(metrics: DataFrame) -> DataFrame:
    return _camelled(metrics)


def topn_view(topn: DataFrame) -> DataFrame:
    return _camelled(topn.withColumnRenamed("entries", "pages"))


def funnel_view(snapshot: DataFrame) -> DataFrame:
    return _camelled(snapshot)


def alerts_view(alerts: DataFrame) -> DataFrame:
    return _camelled(alerts)


def active_view(snapshot: DataFrame) -> DataFrame:
    return _camelled(snapshot)


def share_of_leader(ranked: DataFrame) -> DataFrame:
    """Ranked pages with each one's views as a share of its window's first."""
    first = F.first("views").over(Window.partitionBy("window_start").orderBy("rank"))
    return ranked.withColumn("share", F.when(first == 0, 0.0).otherwise(F.col("views") / first))


def share_of_views(snapshot: DataFrame) -> DataFrame:
    """(stage, visitors, share): a snapshot's stages with their share of the first."""
    names = ("views", "add_to_cart", "checkout_start", "purchases")
    rows = snapshot.select("views", F.expr("stack(4, " + ", ".join(f"{i}, '{n}', {n}" for i, n in enumerate(names)) + ") AS (i, stage, visitors)"))
    return rows.orderBy("i").select("stage", "visitors", F.when(F.col("views") > 0, F.col("visitors") / F.col("views")).otherwise(0.0).alias("share"))


def recent_metrics(metrics: DataFrame, n: int = 30) -> DataFrame:
    """The last ``n`` windows, oldest first."""
    return metrics.orderBy(F.desc("window_start")).limit(n).orderBy("window_start")


def recent_alerts(alerts: DataFrame, n: int = 20) -> DataFrame:
    return alerts.orderBy(F.desc("alert_time")).limit(n)


def live_gauges(metrics: DataFrame) -> DataFrame:
    """(window_start, events_per_sec, conversions_per_min) of the latest window."""
    last = metrics.orderBy(F.desc("window_start")).limit(1)
    return last.select("window_start", F.floor(F.col("events") / 60 + 0.5).cast("long").alias("events_per_sec"), F.col("purchases").alias("conversions_per_min"))
