"""Stored sketches: small mergeable summaries of short buckets, from which any range of them and any longer interval is answered without the events.

A rollup is a table (bucket, keys, sketch ...), made of a batch or, in append mode, of a stream. Sketches merge without loss, so an answer's error is
that of one sketch over all its rows, whatever number of buckets it is put together from.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.params import bucket, in_range, length, resolve_range
from eventloom.operators.olap import latency_ms, on_time
from eventloom.operators.rollups import with_lateness
from eventloom.schemas import LATENCY_CAP_MS, WINDOW, WINDOW_GRACE

#: log2 of a visitor sketch's registers: a standard error of 1.04 / sqrt(2^12), 1.6 %, in 2 to 4 KB at most.
LG_K = 12
#: Size of a latency sketch: a quantile's rank is off by less than 0.4 % with a chance of 99 %, in 5 KB at most.
KLL_K = 800


def visitor_sketches(df: DataFrame, size: str = WINDOW, keys: tuple[str, ...] = (), grace: str = WINDOW_GRACE) -> DataFrame:
    """(bucket, keys, events, visitors): an HLL sketch of each bucket's visitors. Null visitors count for nothing; no events, no rows."""
    counted = with_lateness(df, grace).groupBy(F.window("event_time", size).alias("w"), *keys).agg(F.count("*").alias("events"), F.hll_sketch_agg("anonymous_id", LG_K).alias("visitors"))
    return counted.select(F.col("w.start").alias("bucket"), *keys, "events", "visitors")


def _aligned(from_, to, now, size: str) -> tuple:
    """The range, if it begins and ends with buckets."""
    start, end = resolve_range(from_, to, now)
    step = length(size)
    for at in (start, end):
        if (at - type(at)(1970, 1, 1)) % step != timedelta(0):
            raise ValueError(f"a range over buckets of {size} begins and ends with one, not at {at}")
    return start, end


def visitors_from_sketches(sketches: DataFrame, from_=None, to=None, interval: str | None = None, size: str = WINDOW, now=None) -> DataFrame:
    """(bucket, unique_visitors) over the buckets of [from, to), about as unique_visitors() of the events; ``size`` is that of the stored buckets."""
    start, end = _aligned(from_, to, now, size)
    rows = in_range(sketches, start, end, "bucket").groupBy(bucket("bucket", interval).alias("b")).agg(F.hll_sketch_estimate(F.hll_union_agg("visitors")).alias("unique_visitors"))
    return rows.select(F.col("b").alias("bucket"), "unique_visitors").orderBy("bucket")


def latency_sketches(df: DataFrame, size: str = WINDOW, cap_ms: int = LATENCY_CAP_MS, grace: str = WINDOW_GRACE) -> DataFrame:
    """(bucket, samples, total_ms, max_ms, latencies): a KLL sketch of the latencies of the on-time events that were ingested in a bucket."""
    rows = with_lateness(on_time(df, cap_ms), grace, "ingested_at").select("ingested_at", latency_ms().alias("ms"))
    counted = rows.groupBy(F.window("ingested_at", size).alias("w")).agg(F.count("*").alias("samples"), F.sum("ms").alias("total_ms"), F.max("ms").alias("max_ms"), F.kll_sketch_agg_bigint("ms", F.lit(KLL_K)).alias("latencies"))
    return counted.select(F.col("w.start").alias("bucket"), "samples", "total_ms", "max_ms", "latencies")


def latency_from_sketches(sketches: DataFrame, from_=None, to=None, size: str = WINDOW, now=None) -> DataFrame:
    """One row (samples, p50, p95, p99, max_ms, avg_ms) over the buckets of [from, to): counts, maximum and mean exact, percentiles by the merged sketch.
    Without samples these are null."""
    start, end = _aligned(from_, to, now, size)
    whole = in_range(sketches, start, end, "bucket").agg(F.coalesce(F.sum("samples"), F.lit(0)).alias("samples"), F.sum("total_ms").alias("total"), F.max("max_ms").alias("max_ms"), F.kll_merge_agg_bigint("latencies", F.lit(KLL_K)).alias("s"))
    at = [F.when(F.col("samples") > 0, F.kll_sketch_get_quantile_bigint("s", F.lit(q / 100))).alias(f"p{q}") for q in (50, 95, 99)]
    return whole.select("samples", *at, "max_ms", F.round(F.col("total") / F.col("samples"), 1).alias("avg_ms"))
