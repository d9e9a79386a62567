"""Windowed rollups. Each takes a batch or a streaming DataFrame; a stream gets its watermark here and is written in append mode, so that a
window comes out once, when it is closed. Windows without events give no row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.columns import page_views
from eventloom.schemas import SESSION_GAP, SESSION_GRACE, TOP_N, WINDOW, WINDOW_GRACE


def with_lateness(df: DataFrame, delay: str, time_col: str = "event_time") -> DataFrame:
    """A stream's watermark; a batch has none. Rows within the delay are never dropped; later ones may be kept for one more micro-batch."""
    return df.withWatermark(time_col, delay) if df.isStreaming else df


def counters() -> list[Column]:
    """Counts of all events and of the funnel's, and the purchases' revenue, nulls as 0."""
    of = lambda kind: F.count_if(F.col("event_type") == kind)
    paid = F.when(F.col("event_type") == "purchase", F.coalesce("revenue", F.lit(0.0))).otherwise(F.lit(0.0))
    return [F.count("*").alias("events"), of("page_view").alias("page_views"), of("add_to_cart").alias("add_to_cart"), of("checkout_start").alias("checkout_start"), of("purchase").alias("purchases"), F.sum(paid).alias("revenue")]


def minute_metrics(df: DataFrame, size: str = WINDOW, grace: str = WINDOW_GRACE) -> DataFrame:
    counted = with_lateness(df, grace).groupBy(F.window("event_time", size).alias("w")).agg(*counters())
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events", "page_views", "add_to_cart", "checkout_start", "purchases", "revenue")


def page_views_per_window(df: DataFrame, size: str = WINDOW, grace: str = WINDOW_GRACE) -> DataFrame:
    """(window, path, views); window is left whole, so that a stream can aggregate again by it."""
    return page_views(with_lateness(df, grace)).groupBy(F.window("event_time", size).alias("window"), "path").agg(F.count("*").alias("views"))


def rank_pages(counts: DataFrame, n: int = TOP_N) -> DataFrame:
    """(window_start, window_end, rank, path, views): batch only; most views first, then by path."""
    best = Window.partitionBy("window").orderBy(F.desc("views"), "path")
    ranked = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
    return ranked.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "rank", "path", "views")


def topn_pages(df: DataFrame, n: int = TOP_N, size: str = WINDOW, grace: str = WINDOW_GRACE) -> DataFrame:
    """(window_start, window_end, entries): a window's ``n`` pages as an array in rank order.

    The ranking cuts to n rows a window before they are gathered; on a stream, which has no row_number(), in two steps by shares of the pages.
    A stream needs the RocksDB state store.
    """
    counts = page_views_per_window(df, size, grace)
    if df.isStreaming:
        from eventloom.streaming.stages import best_entries

        return best_entries(counts, n)
    in_order = F.array_sort(F.collect_list(F.struct((-F.col("views")).alias("o"), "path", "views")))
    gathered = rank_pages(counts, n).groupBy("window_start", "window_end").agg(in_order.alias("e"))
    return gathered.select("window_start", "window_end", F.transform("e", lambda x: F.struct(x["path"].alias("path"), x["views"].alias("views"))).alias("entries"))


def sessionize(df: DataFrame, gap: str = SESSION_GAP, grace: str = SESSION_GRACE) -> DataFrame:
    """A row for each run of a visitor's events that lie at most ``gap`` apart: Spark merges session windows that touch.

    user_id is the first known one and entry_path the first event's path, in order of time and event_id. session_end is the last event's time.
    """
    order = F.struct("event_time", "event_id")
    whole = (
        with_lateness(df, grace)
        .groupBy("anonymous_id", F.session_window("event_time", gap).alias("w"))
        .agg(*counters(), F.min("event_time").alias("session_start"), F.max("event_time").alias("session_end"), F.min_by("path", order).alias("entry_path"), F.min_by("user_id", F.when(F.col("user_id").isNotNull(), order)).alias("user_id"))
    )
    ms = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    return whole.select(
        F.concat_ws(":", "anonymous_id", ms("session_start").cast("string")).alias("session_id"), "anonymous_id", "user_id", "session_start", "session_end", (ms("session_end") - ms("session_start")).alias("duration_ms"),
        "events", "page_views", "add_to_cart", "checkout_start", "purchases", "revenue", "entry_path", (F.col("purchases") > 0).alias("converted"),
    )


def active_visitors(df: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """(snapshot_time, active_sessions, window_seconds): visitors whose last event is newer than the newest of all less ``gap``."""
    last = df.groupBy("anonymous_id").agg(F.max("event_time").alias("last"))
    return active_from_last(last, gap)


def active_from_last(last: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """The same from (anonymous_id, last). Empty input gives no row."""
    back = F.expr(f"INTERVAL {gap}")
    now = last.agg(F.max("last")).scalar()
    counted = last.agg(F.max("last").alias("snapshot_time"), F.count_if(F.col("last") > now - back).alias("active_sessions"))
    width = (F.unix_seconds(F.lit("2000-01-01").cast("timestamp") + back) - F.unix_seconds(F.lit("2000-01-01").cast("timestamp"))).alias("window_seconds")
    return counted.where("snapshot_time IS NOT NULL").select("snapshot_time", "active_sessions", width)


def volume_buckets(df: DataFrame, size: str = WINDOW, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, bucket, observed): events in each bucket from a series' first to its last, those without events as 0."""
    counts = df.groupBy(*keys, F.window("event_time", size).start.alias("bucket")).agg(F.count("*").alias("n"))
    ends = counts.groupBy(*keys).agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).where("a IS NOT NULL")
    grid = ends.select(*keys, F.explode(F.sequence("a", "b", F.expr(f"INTERVAL {size}"))).alias("bucket"))
    on = [F.col(f"g.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys] + [F.col("g.bucket") == F.col("c.bucket")]
    joined = grid.alias("g").join(counts.alias("c"), on, "left")
    return joined.select(*[F.col(f"g.{k}").alias(k) for k in keys], F.col("g.bucket").alias("bucket"), F.coalesce("c.n", F.lit(0)).alias("observed"))
