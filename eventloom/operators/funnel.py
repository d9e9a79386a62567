"""Conversion funnels of two kinds. The live one is free of order and time: a later stage credits all before it. The reported one is ordered
and bounded: its steps must follow each other within a window that starts at the first."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.columns import funnel_stage, ratio, seconds
from eventloom.functions.params import in_range, require_positive
from eventloom.schemas import FUNNEL, FUNNEL_SECONDS


def furthest_stage(df: DataFrame) -> DataFrame:
    """(anonymous_id, stage): the furthest of a visitor; visitors without funnel events have no row."""
    staged = df.select("anonymous_id", funnel_stage().alias("stage")).where("stage >= 0")
    return staged.groupBy("anonymous_id").agg(F.max("stage").alias("stage"))


def _rates(counts: DataFrame) -> DataFrame:
    v, a, c, p = (F.col(x) for x in ("views", "add_to_cart", "checkout_start", "purchases"))
    return counts.select("*", ratio(a, v).alias("view_to_cart_rate"), ratio(c, a).alias("cart_to_checkout_rate"), ratio(p, c).alias("checkout_to_purchase_rate"), ratio(p, v).alias("overall_conversion_rate"))


def snapshot_from_stages(stages: DataFrame) -> DataFrame:
    """One row of visitors at each stage and the rates between, from a row (stage) per visitor."""
    reached = [F.count_if(F.col("stage") >= i).alias(n) for i, n in enumerate(("views", "add_to_cart", "checkout_start", "purchases"))]
    return _rates(stages.agg(*reached))


def snapshot_from_counts(counts: DataFrame) -> DataFrame:
    """The same from (stage, visitors), visitors being those who reached the stage."""
    of = lambda i: F.coalesce(F.sum(F.when(F.col("stage") == i, F.col("visitors"))), F.lit(0))
    return _rates(counts.agg(*[of(i).alias(n) for i, n in enumerate(("views", "add_to_cart", "checkout_start", "purchases"))]))


def funnel_snapshot(df: DataFrame) -> DataFrame:
    return snapshot_from_stages(furthest_stage(df))


def window_funnel(df: DataFrame, steps: list[Column] | None = None, window_seconds: int = FUNNEL_SECONDS, key: str = "anonymous_id", time_col: str = "event_time") -> DataFrame:
    """(key, level): how many of ``steps`` (conditions; the funnel's event types by default) a visitor made in order, all within
    ``window_seconds`` of the first, times cut to whole seconds; 0 if none.

    For each event and step the latest valid start is carried along: a step takes over the start of the step before it, if that lies within
    the window. Steps in the same second count as in order. One exchange by visitor and one sort serve all windows, which can spill.
    """
    return _levels(df, steps, window_seconds, key, time_col)


def step_levels(df: DataFrame, steps: list[Column] | None = None, window_seconds: int = FUNNEL_SECONDS, key: str = "anonymous_id", time_col: str = "event_time") -> DataFrame:
    """window_funnel() for the visitors with an event of any step: other events don't travel."""
    steps = steps or [F.col("event_type") == n for n in FUNNEL]
    return _levels(df.where(functools.reduce(lambda a, b: a | b, steps)), steps, window_seconds, key, time_col)


def _levels(df: DataFrame, steps: list[Column] | None, window_seconds: int, key: str, time_col: str) -> DataFrame:
    require_positive("windowSeconds", window_seconds)
    steps = steps or [F.col("event_type") == n for n in FUNNEL]
    step = F.when(steps[0], 1)
    for i, test in enumerate(steps[1:], 2):
        step = step.when(test, i)
    rows = df.select(F.col(key).alias("k"), seconds(time_col).alias("t"), F.coalesce(step, F.lit(0)).alias("step"))
    until = Window.partitionBy("k").orderBy("t", "step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("c1", F.when(F.col("step") == 1, F.col("t")))
    for i in range(2, len(steps) + 1):
        start = F.max(f"c{i - 1}").over(until)
        rows = rows.withColumn(f"p{i}", start).withColumn(f"c{i}", F.when((F.col("step") == i) & (F.col("t") <= F.col(f"p{i}") + window_seconds), F.col(f"p{i}")))
    made = F.greatest(F.lit(0), *[F.when(F.col(f"c{i}").isNotNull(), i) for i in range(1, len(steps) + 1)])
    return rows.groupBy(F.col("k").alias(key)).agg(F.max(made).alias("level"))


def funnel_report(df: DataFrame, from_=None, to=None, window_seconds: int = FUNNEL_SECONDS, now=None) -> DataFrame:
    """(stage, visitors, conversion_from_top, conversion_from_prev), four rows for any input."""
    require_positive("windowSeconds", window_seconds)
    return report_from_levels(step_levels(in_range(df, from_, to, now=now), window_seconds=window_seconds))


def report_from_levels(levels: DataFrame, weight: str | None = None) -> DataFrame:
    """From a row (level) per visitor, or with ``weight`` from a histogram of levels."""
    n = F.col(weight) if weight else F.lit(1)
    reached = levels.agg(*[F.coalesce(F.sum(F.when(F.col("level") >= i, n)), F.lit(0)).cast("long").alias(f"n{i}") for i in range(1, 5)])
    rows = reached.select(F.expr("stack(4, " + ", ".join(f"{i}, '{s}', n{i}, n1, n{max(i - 1, 1)}" for i, s in enumerate(FUNNEL, 1)) + ") AS (i, stage, visitors, top, prev)"))
    prev = F.when(F.col("i") == 1, F.lit(1.0)).otherwise(ratio(F.col("visitors"), F.col("prev")))
    return rows.orderBy("i").select("stage", "visitors", ratio(F.col("visitors"), F.col("top")).alias("conversion_from_top"), prev.alias("conversion_from_prev"))


def kpis(report: DataFrame) -> DataFrame:
    """One row from a report: visitors who viewed, put into a cart and bought, and the rates among them."""
    of = lambda s: F.coalesce(F.max(F.when(F.col("stage") == s, F.col("visitors"))), F.lit(0))
    row = report.agg(of("page_view").alias("view_visitors"), of("add_to_cart").alias("cart_visitors"), of("purchase").alias("purchase_visitors"))
    v, c, p = (F.col(x) for x in ("view_visitors", "cart_visitors", "purchase_visitors"))
    return row.select("*", ratio(c, v).alias("cart_rate"), ratio(p, v).alias("conversion_rate"))
