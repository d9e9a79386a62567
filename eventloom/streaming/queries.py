"""Streaming queries whose results are snapshots or alerts.

What a stream must remember lies in the state store (stages.py). Totals over it are a few numbers in numbered folders: batch n reads what batch
n - 1 left and writes its own, so a batch that is tried again does the same again.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from eventloom.functions.params import length
from eventloom.operators.funnel import snapshot_from_counts
from eventloom.operators.rollups import with_lateness
from eventloom.schemas import ALPHA, SESSION_GAP, SNAPSHOT_EVERY, THRESHOLD_K, WARMUP, WINDOW, WINDOW_GRACE
from eventloom.streaming.stages import active_changes, baseline_alerts, stage_deltas

#: (result of a batch, batch number) -> None; called again with the same number if a batch is tried again.
Sink = Callable[[DataFrame, int], None]


def _folders(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _before(spark: SparkSession, root: str, batch_id: int) -> str | None:
    """The newest complete state older than the batch."""
    path, fs = _folders(spark, root)
    if not fs.exists(path):
        return None
    done = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(path) if s.getPath().getName().startswith("batch=")]
    done = [n for n in done if n < batch_id and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/batch={n}/_SUCCESS"))]
    return f"{root}/batch={max(done)}" if done else None


def _forget(spark: SparkSession, root: str, batch_id: int, keep: int = 2) -> None:
    path, fs = _folders(spark, root)
    for s in fs.listStatus(path):
        name = s.getPath().getName()
        if name.startswith("batch=") and int(name.split("=")[1]) <= batch_id - keep:
            fs.delete(s.getPath(), True)


def _totalled(state_path: str, merge: Callable[[DataFrame, DataFrame | None], DataFrame], batch: DataFrame, batch_id: int) -> DataFrame:
    """Merges a batch's few totals with those of all batches before it, and keeps them."""
    spark = batch.sparkSession
    before = _before(spark, state_path, batch_id)
    now = f"{state_path}/batch={batch_id}"
    merge(batch, spark.read.parquet(before) if before else None).coalesce(1).write.mode("overwrite").parquet(now)
    _forget(spark, state_path, batch_id)
    return spark.read.parquet(now)


def _start(df: DataFrame, put: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None, mode: str = "append"):
    return df.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": SNAPSHOT_EVERY})).start()


def with_ticks(df: DataFrame) -> DataFrame:
    """df as the struct ``row``, with a null one each second: so a batch is due at each trigger, though df be idle."""
    ticks = df.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    row = F.struct(*df.columns).alias("row")
    return df.select(row).union(ticks.select(F.lit(None).cast(df.select(row).schema["row"].dataType).alias("row")))


def start_snapshots(df: DataFrame, build: Callable[[DataFrame], DataFrame], sink: Sink, checkpoint: str, every: str = SNAPSHOT_EVERY, mode: str = "append", trigger: dict | None = None, idle: bool = True):
    """Each batch through ``build`` into ``sink``, stamped with snapshot_time. With ``idle`` there is one at each trigger, whether there is new data or
    not; ``build`` then gets an empty batch, whose snapshot is of what is known."""

    def put(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where("row IS NOT NULL").select("row.*") if idle else batch
        sink(build(rows).withColumn("snapshot_time", F.current_timestamp()), batch_id)

    return _start(with_ticks(df) if idle else df, put, checkpoint, trigger or {"processingTime": every}, mode)


def start_live_funnel(df: DataFrame, state_path: str, sink: Sink, checkpoint: str, ttl: str | None = None, trigger: dict | None = None, idle: bool = True):
    """Funnel snapshots since the start, at each trigger: newly reached stages are added to four counters."""

    def merge(new: DataFrame, old: DataFrame | None) -> DataFrame:
        new = new.groupBy("stage").agg(F.count("*").alias("visitors"))
        return new if old is None else old.unionByName(new).groupBy("stage").agg(F.sum("visitors").alias("visitors"))

    def put(batch: DataFrame, batch_id: int) -> None:
        reached = batch.where("row IS NOT NULL").select("row.*") if idle else batch
        counts = _totalled(state_path, merge, reached, batch_id)
        sink(snapshot_from_counts(counts).withColumn("snapshot_time", F.current_timestamp()), batch_id)

    deltas = stage_deltas(df, ttl)
    return _start(with_ticks(deltas) if idle else deltas, put, checkpoint, trigger)


def start_active_visitors(df: DataFrame, state_path: str, sink: Sink, checkpoint: str, gap: str = SESSION_GAP, trigger: dict | None = None):
    """Snapshots of active_visitors(), without a time of their own: (snapshot_time, active_sessions, window_seconds), snapshot_time being the clock's.

    A visitor's state is its last time and a timer; a batch writes that of the visitors it has and of those who become idle. Spark takes the newest
    time of a batch into account in the next one, which it runs at once, with or without new rows: that batch's snapshot is exact.
    """
    width = int(length(gap).total_seconds())

    def merge(changes: DataFrame, old: DataFrame | None) -> DataFrame:
        total = changes.agg(F.coalesce(F.sum("change"), F.lit(0)).cast("long").alias("active_sessions"))
        return total if old is None else old.union(total).agg(F.sum("active_sessions").alias("active_sessions"))

    def put(batch: DataFrame, batch_id: int) -> None:
        active = _totalled(state_path, merge, batch, batch_id)
        sink(active.select(F.current_timestamp().alias("snapshot_time"), "active_sessions", F.lit(width).cast("long").alias("window_seconds")), batch_id)

    return _start(active_changes(df, gap), put, checkpoint, trigger)


def anomaly_alerts(df: DataFrame, size: str = WINDOW, grace: str = WINDOW_GRACE, keys: tuple[str, ...] = (), alpha: float = ALPHA, k: float = THRESHOLD_K, warmup: int = WARMUP) -> DataFrame:
    """A stream's alerts on event-time buckets, each scored when it is closed; buckets without events between two closed ones count as 0.

    One query with two states: the open buckets' counts, and a series' baseline and last bucket. Spark commits both with the batch, so a bucket is
    folded once, whatever is tried again.
    """
    closed = with_lateness(df, grace).groupBy(F.window("event_time", size).alias("w"), *keys).agg(F.count("*").alias("observed")).select(*keys, F.col("w.start").alias("bucket"), "observed")
    return baseline_alerts(closed, length(size), alpha, k, warmup, keys)


def start_anomaly_alerts(df: DataFrame, sink: Sink, checkpoint: str, trigger: dict | None = None, **parameters):
    """anomaly_alerts() of each batch into ``sink``."""
    return _start(anomaly_alerts(df, **parameters), sink, checkpoint, trigger)


def observe_source(df: DataFrame, name: str = "source") -> DataFrame:
    """Counts a stream's rows as they pass; a query's recentProgress has the figure under ``name``, and ThroughputListener takes it up."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


class ThroughputListener(StreamingQueryListener):
    """Samples of how many rows a query's batches took at three stages: read from its sources, passed where observe_source() named ``processed``
    stands, and written to its sink (where the sink can tell, or where a second observation named ``written`` stands).

    Add with spark.streams.addListener(). ``queries``: names of the queries to follow; all if not given. The last ``keep`` samples stay.
    """

    STAGES = ("source", "processed", "written")

    def __init__(self, queries: tuple[str, ...] | None = None, keep: int = 100_000):
        self.queries, self.rows = queries, deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.queries is not None and p.name not in self.queries:
            return
        began, took = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")), p.batchDuration / 1000
        seen = {k: r["rows"] for k, r in (p.observedMetrics or {}).items() if k in self.STAGES}
        written = seen.get("written", p.sink.numOutputRows if p.sink is not None and p.sink.numOutputRows >= 0 else None)
        for stage, n in (("source", p.numInputRows), ("processed", seen.get("processed")), ("written", written)):
            if n is not None:
                self.rows.append((p.name, stage, p.batchId, began, took, int(n)))

    def samples(self, spark: SparkSession) -> DataFrame:
        """(query, stage, batch, sample_start, seconds, events, events_per_second); mean_throughput() takes it."""
        rows = spark.createDataFrame(list(self.rows), "query string, stage string, batch long, sample_start timestamp, seconds double, events long")
        return rows.withColumn("events_per_second", F.when(F.col("seconds") > 0, F.col("events") / F.col("seconds")).otherwise(0.0))


def enrich_per_batch(df: DataFrame, read_products: Callable[[SparkSession], DataFrame], sink: Sink, checkpoint: str, trigger: dict | None = None):
    """enrich() with the dimension read anew in each batch, for dimensions that change."""
    from eventloom.operators.enrich import enrich

    return _start(df, lambda batch, n: sink(enrich(batch, read_products(batch.sparkSession)), n), checkpoint, trigger)
