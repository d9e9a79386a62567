"""State of streams, kept in the state store (RocksDB): stages reached, visitors active, best pages of a window, baselines of volumes.

All of it is written by Spark with the batch that changed it, in proportion to that batch, and a batch that is tried again begins from the same state.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventloom.functions.columns import funnel_stage

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class _Stateful(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def close(self) -> None:
        pass


def stage_deltas(df: DataFrame, ttl: str | None = None) -> DataFrame:
    """(anonymous_id, stage) of a stream: each stage that a visitor reaches for the first time, at most one row for each ever; a later stage credits all
    before it. The state is one key for each, in the JVM.

    ``ttl``: an interval of event time after which a visitor's stages are forgotten and may be reached again; such streams drop events that are later.
    """
    staged = df.select("anonymous_id", funnel_stage().alias("stage"), *(["event_time"] if ttl else [])).where("stage >= 0")
    if ttl:
        staged = staged.withWatermark("event_time", ttl)
    each = staged.withColumn("stage", F.explode(F.sequence(F.lit(0), F.col("stage"))))
    new = each.dropDuplicatesWithinWatermark(["anonymous_id", "stage"]) if ttl else each.dropDuplicates(["anonymous_id", "stage"])
    return new.select("anonymous_id", "stage")


class ActiveChange(_Stateful):
    """1 when a visitor becomes active, -1 when the stream's newest time has left the last event behind: then the visitor's state goes.

    The watermark is the newest time of all less the gap, so a timer at the last event's time fires when the visitor is idle.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = max((int(r["ms"].max()) for r in rows if len(r)), default=None)
        known = self.last.get()[0] if self.last.exists() else None
        if newest is None or (known is not None and newest <= known):
            return
        if known is not None:
            self.handle.deleteTimer(known)
        self.last.update((newest,))
        self.handle.registerTimer(newest)
        if known is None:
            yield pd.DataFrame({"change": [1]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield pd.DataFrame({"change": [-1]})


def active_changes(df: DataFrame, gap: str) -> DataFrame:
    """(change) of a stream: how the number of visitors with an event in the last ``gap`` before the newest one changes. Events that lie further back
    than that are late, and no visitor is active by them."""
    rows = df.select("anonymous_id", "event_time").withWatermark("event_time", gap)
    # Timers have milliseconds; the last event's are rounded up, so that it is left behind no sooner than it is.
    rows = rows.select("anonymous_id", "event_time", F.ceil(F.unix_micros(F.col("event_time").cast("timestamp")) / 1000).alias("ms"))
    return rows.groupBy("anonymous_id").transformWithStateInPandas(ActiveChange(), outputStructType="change int", outputMode="Append", timeMode="EventTime")


class Best(_Stateful):
    """The ``n`` pages of a key with the most views, then by path, from rows (path, views).

    An append aggregation gives a window's rows in one batch, when it is closed. So a key is whole in one call, chunk by chunk, and needs no state.
    """

    def __init__(self, n: int, gathered: bool):
        self.n, self.gathered = n, gathered

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best: list[tuple[int, str]] = []
        for r in rows:
            best = heapq.nsmallest(self.n, [*best, *((-int(v), p) for p, v in zip(r["path"], r["views"], strict=True))])
        if self.gathered and best:
            yield pd.DataFrame({"window_start": [key[0]], "window_end": [key[1]], "entries": [[{"path": p, "views": -v} for v, p in best]]})
        elif best:
            yield pd.DataFrame({"window_start": [key[0]] * len(best), "window_end": [key[1]] * len(best), "path": [p for _, p in best], "views": [-v for v, _ in best]})


def best_entries(counts: DataFrame, n: int, shares: int = 32) -> DataFrame:
    """(window_start, window_end, entries) of a stream's closed windows, from (window, path, views): each of ``shares`` parts of a window's pages gives
    its ``n`` best, and of these the window's are taken, so no row holds more than n pages and no call more than n of a part."""
    kind = counts.schema["window"].dataType["start"].dataType.simpleString()
    rows = counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "path", "views", F.pmod(F.xxhash64("path"), F.lit(shares)).alias("part"))
    some = rows.groupBy("window_start", "window_end", "part").transformWithStateInPandas(Best(n, False), outputStructType=f"window_start {kind}, window_end {kind}, path string, views long", outputMode="Append", timeMode="None")
    return some.groupBy("window_start", "window_end").transformWithStateInPandas(Best(n, True), outputStructType=f"window_start {kind}, window_end {kind}, entries array<struct<path: string, views: bigint>>", outputMode="Append", timeMode="None")


class Baseline(_Stateful):
    """A series' closed buckets, scored one after the other against the mean and deviation of those before; buckets without events between count as 0."""

    def __init__(self, step: timedelta, alpha: float, k: float, warmup: int, keys: int):
        self.step, self.alpha, self.k, self.warmup, self.keys = step, alpha, k, warmup, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getValueState("baseline", "mean double, var double, n long, last timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        closed = sorted((t.to_pydatetime(), int(n)) for r in rows for t, n in zip(r["bucket"], r["observed"], strict=True))
        mean, var, n, last = self.state.get() if self.state.exists() else (0.0, 0.0, 0, None)
        found: list[tuple] = []
        for bucket, observed in closed:
            at = last + self.step if last is not None else bucket
            while at <= bucket:
                seen = float(observed) if at == bucket else 0.0
                sd = max(math.sqrt(var), math.sqrt(max(mean, 1.0)))
                z = (seen - mean) / sd
                if n >= self.warmup and abs(z) >= self.k:
                    found.append((at, int(seen), mean, sd, z, n))
                d = seen - mean
                mean, var = (seen, 0.0) if n == 0 else (mean + self.alpha * d, (1 - self.alpha) * (var + self.alpha * d * d))
                n, last, at = n + 1, at, at + self.step
        if closed:
            self.state.update((mean, var, n, last))
        if found:
            columns = dict(zip(("alert_time", "observed", "baseline_mean", "baseline_stddev", "z_score", "baseline_samples"), map(list, zip(*found, strict=True)), strict=True))
            yield pd.DataFrame({**{f"k{i}": [key[i]] * len(found) for i in range(self.keys)}, **columns})


def baseline_alerts(closed: DataFrame, step: timedelta, alpha: float, k: float, warmup: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Alerts of a stream of closed buckets (keys, bucket, observed), which an append aggregation gives in order: as ewma_alerts() of a batch."""
    kinds = dict(closed.dtypes)
    rows = closed.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)], F.col("bucket").cast("timestamp").alias("bucket"), "observed")
    rows = rows if keys else rows.withColumn("k0", F.lit(0))
    by = [f"k{i}" for i in range(max(1, len(keys)))]
    spec = ", ".join([*(f"k{i} {kinds[c]}" for i, c in enumerate(keys)), "alert_time timestamp", "observed long", "baseline_mean double", "baseline_stddev double", "z_score double", "baseline_samples long"])
    out = rows.groupBy(*by).transformWithStateInPandas(Baseline(step, alpha, k, warmup, len(keys)), outputStructType=spec, outputMode="Append", timeMode="None")
    way = F.when(F.col("observed") >= F.col("baseline_mean"), F.lit("spike")).otherwise(F.lit("drop"))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keys)], F.col("alert_time").cast(kinds["bucket"]).alias("alert_time"), "observed", "baseline_mean", "baseline_stddev", "z_score", F.lit(float(k)).alias("threshold_k"), way.alias("direction"), "baseline_samples")
