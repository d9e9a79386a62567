"""Ad-hoc queries over a range of the event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import millis, page_views
from eventloom.functions.params import bucket, in_range, of_type, parse_interval, require_positive
from eventloom.operators.rollups import with_lateness
from eventloom.schemas import LATENCY_CAP_MS, LATENCY_WINDOW_S, TOP_N, WINDOW_GRACE


def unique_visitors(df: DataFrame, from_=None, to=None, interval: str | None = None, exact: bool = False, rsd: float = 0.02, now=None, grace: str = WINDOW_GRACE) -> DataFrame:
    """(bucket, unique_visitors), approximate unless ``exact``: a sketch is merged, not a set of visitors.

    A stream takes sketches only, and comes in no order, in append mode each bucket once when it is closed.
    """
    if exact and df.isStreaming:
        raise ValueError("a stream's visitors are counted approximately")
    count = F.count_distinct("anonymous_id") if exact else F.approx_count_distinct("anonymous_id", rsd)
    rows = with_lateness(in_range(df, from_, to, now=now), grace)
    return _in_buckets(rows, interval, [count.alias("unique_visitors")])


def _in_buckets(rows: DataFrame, interval: str | None, aggregates: list[Column], *keys: str) -> DataFrame:
    """Aggregates by bucket and keys. A stream is grouped by the whole window, as its start alone has no watermark; a batch by the start, a long."""
    if not rows.isStreaming:
        return rows.groupBy(bucket("event_time", interval).alias("bucket"), *keys).agg(*aggregates).orderBy("bucket", *keys)
    counted = rows.groupBy(F.window("event_time", parse_interval(interval)).alias("w"), *keys).agg(*aggregates)
    return counted.select(F.col("w.start").alias("bucket"), *[c for c in counted.columns if c != "w"])


def retention(df: DataFrame, conditions: list[Column], key: str = "anonymous_id") -> DataFrame:
    """One row (r0, r1, ...): visitors who meet the first condition, and of these those who also meet each other, with any of their events."""
    met = df.groupBy(key).agg(*[F.max(F.coalesce(c, F.lit(False))).alias(f"c{i}") for i, c in enumerate(conditions)])
    kept = lambda i: F.col("c0") & F.col(f"c{i}")
    return met.agg(*[F.coalesce(F.sum(kept(i).cast("long")), F.lit(0)).alias(f"r{i}") for i in range(len(conditions))])


def timeseries(df: DataFrame, from_=None, to=None, interval: str | None = None, event_type: str | None = None, now=None, grace: str = WINDOW_GRACE) -> DataFrame:
    """(bucket, event_type, events); of a stream in no order, in append mode each bucket once when it is closed."""
    rows = with_lateness(of_type(in_range(df, from_, to, now=now), event_type), grace)
    return _in_buckets(rows, interval, [F.count("*").alias("events")], "event_type")


def top_pages(df: DataFrame, from_=None, to=None, limit: int = TOP_N, now=None) -> DataFrame:
    """(path, views), most viewed first, then by path."""
    require_positive("limit", limit)
    return page_views(in_range(df, from_, to, now=now)).groupBy("path").agg(F.count("*").alias("views")).orderBy(F.desc("views"), "path").limit(limit)


def profile(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("events"), F.count_distinct("anonymous_id").alias("visitors"))


def total_series(series: DataFrame, event_type: str | None = None) -> DataFrame:
    return of_type(series, event_type).groupBy("bucket").agg(F.sum("events").alias("events")).orderBy("bucket")


def event_types(series: DataFrame) -> DataFrame:
    return series.select("event_type").distinct().orderBy("event_type")


def latency_ms(event_col: str = "event_time", ingest_col: str = "ingested_at") -> Column:
    return millis(ingest_col) - millis(event_col)


def on_time(df: DataFrame, cap_ms: int = LATENCY_CAP_MS) -> DataFrame:
    return df.where(latency_ms().between(0, cap_ms))


def latency_profile(df: DataFrame, window_s: int = LATENCY_WINDOW_S, cap_ms: int = LATENCY_CAP_MS, as_of=None, exact: bool = False) -> DataFrame:
    """One row of the on-time events ingested in the last ``window_s`` seconds before ``as_of`` (default: now)."""
    kind = dict(df.dtypes)["ingested_at"]
    end = F.lit(as_of.isoformat(sep=" ")).cast(kind) if as_of is not None else F.current_timestamp().cast(kind)
    rows = on_time(df.where((F.col("ingested_at") > end - F.expr(f"INTERVAL {int(window_s)} SECONDS")) & (F.col("ingested_at") <= end)), cap_ms).select(latency_ms().alias("ms"))
    at = (lambda q: F.percentile("ms", q)) if exact else (lambda q: F.percentile_approx("ms", q, 10_000))
    return rows.agg(F.count("*").alias("samples"), *[F.round(at(q / 100)).cast("long").alias(f"p{q}") for q in (50, 95, 99)], F.max("ms").alias("max_ms"), F.round(F.avg("ms"), 1).alias("avg_ms"))


def throughput(df: DataFrame, time_col: str = "event_time", sample: str = "5 seconds") -> DataFrame:
    """(sample_start, events, events_per_second)."""
    w = F.window(time_col, sample)
    counted = df.groupBy(w.alias("w")).agg(F.count("*").alias("events"))
    length = F.unix_seconds(F.col("w.end").cast("timestamp")) - F.unix_seconds(F.col("w.start").cast("timestamp"))
    return counted.select(F.col("w.start").alias("sample_start"), "events", (F.col("events") / length).alias("events_per_second"))


def mean_throughput(samples: DataFrame) -> DataFrame:
    return samples.agg(F.count("*").alias("samples"), F.avg("events_per_second").alias("mean_events_per_second"))
