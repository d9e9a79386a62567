"""Streams replayed from files against the batch result over the same rows."""

import shutil
import time

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import EVENT, at, dicts, frame, rows
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from eventloom.functions.columns import funnel_stage
from eventloom.operators import anomaly, funnel, olap, rollups
from eventloom.operators.enrich import enrich
from eventloom.schemas import PRODUCT
from eventloom.sources import sinks
from eventloom.streaming import queries as streaming
from eventloom.streaming import stages

W = "2026-07-02T10:00:00"
LAST = (10 * 86_400, "click", "/end", {"anonymous_id": "flush"})  # closes every window before it
NOW = {"availableNow": True}

EVENTS = [(i * 37 % 5400, ("page_view", "add_to_cart", "checkout_start", "purchase", "search")[i % 5 if i % 3 else 0], f"/p{i % 4}", {"anonymous_id": f"v{i % 6}", "revenue": float(i) if i % 5 == 4 else None, "event_id": f"x{i:04d}"}) for i in range(200)]


@pytest.fixture
def replay(spark, tmp_path):
    """Writes each list of events as one file, oldest first, and reads them as a stream of one file a batch."""

    def run(*files):
        path = tmp_path / "in"
        path.mkdir()
        for i, events in enumerate(files):
            kinds = {"event_time": pa.timestamp("us", "UTC"), "price": pa.float64(), "revenue": pa.float64()}
            schema = pa.schema([(f.name, kinds.get(f.name, pa.string())) for f in EVENT.fields])
            pq.write_table(pa.Table.from_pylist([dict(zip(EVENT.names, r, strict=True)) for r in rows(W, *events)], schema), path / f"{i:03d}.parquet")
            time.sleep(0.02)
        return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(str(path))

    return run


def drained(spark, df, name, checkpoint, mode="append"):
    q = sinks.write_rollup(df, name, {"format": "memory"}, mode, trigger=NOW) if mode != "complete" else df.writeStream.queryName(name).format("memory").outputMode("complete").trigger(**NOW).start()
    q.awaitTermination()
    return spark.table(name)


def same(a, b):
    key = lambda r: str(sorted(r.items()))
    assert sorted(map(str, map(key, dicts(a)))) == sorted(map(str, map(key, dicts(b))))


@pytest.mark.parametrize("name, build", [("metrics", rollups.minute_metrics), ("topn", rollups.topn_pages), ("sessions", lambda d: rollups.sessionize(d, "5 minutes"))])
def test_stream_equals_batch(spark, replay, tmp_path, name, build):
    events = sorted(EVENTS, key=lambda e: e[0])
    # Spark filters page views before it takes their times as the watermark, so these must come to close windows of theirs; and what one
    # aggregation emits reaches the next in the batch after.
    ends = [[(d * 86_400, "page_view", "/end")] for d in (10, 11)] if name == "topn" else [[LAST]]
    got = drained(spark, build(replay(events[:90], events[90:], *ends)), f"s_{name}", tmp_path)
    if name == "topn":
        got = got.where(F.col("window_start") < F.lit(at(W, 86_400)))
    want = build(frame(spark, W, *events))
    same(got, want.select(got.columns))


def test_late_rows(spark, replay, tmp_path):
    """One is late by then and dropped, one lies within the grace and counts. Lateness is judged by the watermark of the batch before."""
    files = [[(0, "click")], [(300, "click")], [(301, "click")], [(1, "search"), (297, "search")], [LAST]]
    got = {r["window_start"]: r["events"] for r in dicts(drained(spark, rollups.minute_metrics(replay(*files)), "late", tmp_path))}
    assert got == {at(W): 1, at(W, 240): 1, at(W, 300): 2}


def test_sessions_are_bridged(spark, replay, tmp_path):
    got = drained(spark, rollups.sessionize(replay([(0, "click"), (40, "click")], [(20, "click")], [LAST]), "30 seconds"), "bridge", tmp_path)
    assert [(r["events"], r["duration_ms"]) for r in dicts(got)] == [(3, 40_000)]


def test_enrich_stream(spark, replay, tmp_path):
    products = spark.createDataFrame([("1", "toys", 2.0)], PRODUCT)
    got = drained(spark, enrich(replay([(0, "click", "/", {"product_id": "1"}), (1, "click", "/", {"product_id": "2"})]), products), "enriched", tmp_path)
    assert sorted((r["product_id"], r["product_category"]) for r in dicts(got)) == [("1", "toys"), ("2", None)]


def until(q, done, seconds=90):
    """Lets a query run until it has done something."""
    end = time.time() + seconds
    while not done() and time.time() < end and q.isActive:
        time.sleep(0.2)
    if q.exception():
        raise q.exception()
    assert done()
    q.stop()


def test_live_funnel(spark, replay, tmp_path):
    seen = []
    q = streaming.start_live_funnel(replay(EVENTS[:70], EVENTS[70:140], EVENTS[140:]), str(tmp_path / "state"), lambda df, n: seen.append(df.drop("snapshot_time").first().asDict()), str(tmp_path / "cp"), trigger=NOW, idle=False)
    q.awaitTermination()
    assert seen[-1] == funnel.funnel_snapshot(frame(spark, W, *EVENTS)).first().asDict() and len(seen) >= 3
    assert seen[0]["views"] <= seen[-1]["views"]


def test_idle_streams_have_snapshots(spark, replay, tmp_path):
    """One batch of events, and snapshots go on."""
    seen = []
    q = streaming.start_live_funnel(replay(EVENTS[:70]), str(tmp_path / "state"), lambda df, n: seen.append(df.first().asDict()), str(tmp_path / "cp"), trigger={"processingTime": "500 milliseconds"})
    until(q, lambda: sum(s["views"] > 0 for s in seen) >= 3)
    full = [s for s in seen if s["views"]]
    assert len({s["views"] for s in full}) == 1 and len({s["snapshot_time"] for s in full}) == len(full)


def test_stage_deltas(spark, replay, tmp_path):
    class FunnelAdvance(StatefulProcessor):
        """What stage_deltas() does without Python: the furthest stage of a visitor as a value."""

        def init(self, handle):
            self.furthest = handle.getValueState("furthest", "stage int")

        def handleInputRows(self, key, rows, timerValues):
            known = self.furthest.get()[0] if self.furthest.exists() else -1
            most = max((int(r["stage"].max()) for r in rows if len(r)), default=-1)
            if most > known:
                self.furthest.update((most,))
                yield pd.DataFrame({"anonymous_id": [key[0]] * (most - known), "stage": range(known + 1, most + 1)})

        def close(self):
            pass

    stream = replay(EVENTS[:70], EVENTS[70:140], EVENTS[140:])
    staged = stream.select("anonymous_id", funnel_stage().alias("stage")).where("stage >= 0")
    slow = staged.groupBy("anonymous_id").transformWithStateInPandas(FunnelAdvance(), outputStructType="anonymous_id string, stage int", outputMode="Update", timeMode="None")
    got = {}
    for name, df, mode in (("jvm", stages.stage_deltas(stream), "append"), ("python", slow, "update")):
        found = got[name] = []
        df.writeStream.foreachBatch(lambda b, n, found=found: found.extend((n, *r) for r in b.collect())).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(**NOW).start().awaitTermination()
    assert sorted(got["jvm"]) == sorted(got["python"]) and len(got["jvm"]) > 6


def test_stages_are_forgotten(spark, replay, tmp_path):
    """State goes at the end of the first batch that knows the newer time."""
    view = lambda s, who="a": (s, "page_view", "/", {"anonymous_id": who})
    got = []
    stages.stage_deltas(replay([view(0)], [view(10)], [view(7300, "b")], [view(7350, "c")], [view(7400)]), "1 hour").writeStream.foreachBatch(lambda b, n: got.extend(r[0] for r in b.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(**NOW).start().awaitTermination()
    assert got == ["a", "b", "c", "a"]


def test_active_visitors(spark, replay, tmp_path):
    """After each step the count is that of the batch form over all events so far; events at the limit, late, repeated and out of order among them."""
    who = lambda s, x: (s, "click", "/", {"anonymous_id": x})
    files = [[who(0, "old"), who(900, "a")], [who(1900, "b")], [who(1800, "c")], [who(900 + 1800, "d"), who(2699, "b")], [who(100, "late"), who(950, "a")], [who(2750, "d")], [who(9000, "e")]]
    want, all_of = [], []
    for f in files:
        all_of += f
        want.append(rollups.active_visitors(frame(spark, W, *all_of)).first()["active_sessions"])
    seen = {}
    q = streaming.start_active_visitors(replay(*files), str(tmp_path / "state"), lambda df, n: seen.update({n: tuple(df.first())[1:]}), str(tmp_path / "cp"), trigger=NOW)
    q.awaitTermination()
    inputs = [p.numInputRows for p in q.recentProgress]
    after = [seen[p.batchId][0] for p in q.recentProgress if p.batchId in seen]
    exact = [a for i, a in enumerate(after) if i + 1 == len(after) or inputs[i + 1]]  # a batch without rows has taken the newest time in
    assert exact[-1] == want[-1] == 1 and {w for _, w in seen.values()} == {1800}
    assert set(want) <= set(after)


def test_many_pages_in_a_window(spark, replay, tmp_path):
    events = [(i % 50, "page_view", f"/p{i * 7919 % 20_000}") for i in range(40_000)] + [(3, "page_view", f"/p{i % 30}") for i in range(3000)]
    got = drained(spark, rollups.topn_pages(replay(events, [(86_400, "page_view", "/end")], [(2 * 86_400, "page_view", "/end")])), "many", tmp_path).where(F.col("window_start") < F.lit(at(W, 3600)))
    same(got, rollups.topn_pages(frame(spark, W, *events)).select(got.columns))


@pytest.mark.parametrize("keys", [(), ("path",)])
def test_anomaly_alerts(spark, replay, tmp_path, keys):
    counts = [10, 12, 9, 0, 0, 11, 10, 80, 10, 9, 0, 12, 60, 10]
    events = [(60 * b + i % 50, "click", f"/{i % 2}") for b, n in enumerate(counts) for i in range(n)]
    stream = replay(events[:25], events[25:60], events[60:140], events[140:], [(60 * len(counts) + 100, "click", "/0")])
    want = dicts(anomaly.ewma_alerts(rollups.volume_buckets(frame(spark, W, *events), keys=keys), k=2.0, keys=keys))
    seen, failed = {}, []

    def sink(df, n):
        seen[n] = dicts(df)
        if len(seen) == 3 and not failed:  # after the batch's work; it is tried again
            failed.append(n)
            raise RuntimeError("lost")

    q = streaming.start_anomaly_alerts(stream, sink, str(tmp_path / "cp"), trigger=NOW, k=2.0, keys=keys)
    with pytest.raises(Exception, match="lost"):
        q.awaitTermination()
    streaming.start_anomaly_alerts(stream, sink, str(tmp_path / "cp"), trigger=NOW, k=2.0, keys=keys).awaitTermination()
    key = lambda r: (r["alert_time"], r.get("path"))
    assert len(want) >= 2 and failed and sorted([r for found in seen.values() for r in found], key=key) == sorted(want, key=key)


def test_throughput_of_a_stream(spark, replay, tmp_path):
    listener = streaming.ThroughputListener(("measured",))
    spark.streams.addListener(listener)
    try:
        stream = streaming.observe_source(replay(EVENTS[:70], EVENTS[70:140], EVENTS[140:]).where("event_type != 'search'"), "processed")
        stream.writeStream.queryName("measured").format("memory").option("checkpointLocation", str(tmp_path / "cp")).trigger(**NOW).start().awaitTermination()
        kept = spark.table("measured").count()
        end = time.time() + 30
        while sum(r[1] == "source" for r in listener.rows) < 3 and time.time() < end:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    samples = listener.samples(spark)
    got = {r["stage"]: r["n"] for r in samples.groupBy("stage").agg(F.sum("events").alias("n")).collect()}
    assert got == {"source": 200, "processed": kept, "written": kept} and 0 < kept < 200
    assert olap.mean_throughput(samples.where("stage = 'source'")).first()["samples"] == 3


def test_event_table_and_dead_letters(spark, replay, tmp_path):
    stream = replay([(0, "click"), (1, "unheard_of")], [(2, "click")])
    q = sinks.write_split(stream, str(tmp_path / "t"), str(tmp_path / "dlq"), str(tmp_path / "cp"), trigger=NOW)
    q.awaitTermination()
    assert sinks.read_table(spark, str(tmp_path / "t")).count() == 2
    assert [r["reason"] for r in dicts(sinks.read_table(spark, str(tmp_path / "dlq")))] == ["unknown event_type"]


def test_a_failed_batch_is_replaced(spark, replay, tmp_path, monkeypatch):
    """The first try of a batch fails after it has written; a restart writes each row once all the same."""
    path, dlq, cp = (str(tmp_path / x) for x in ("t", "dlq", "cp"))
    events = [(i, "click" if i % 3 else "unheard_of") for i in range(30)]
    stream = replay(events[:10], events[10:20], events[20:])
    put, calls = sinks._put, []

    def failing(*args):
        put(*args)
        calls.append(args)
        if len(calls) in (1, 4):  # after the valid rows of one batch, and after the rejected ones of another
            raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "_put", failing)
    for ends in (False, False, True):
        q = sinks.write_split(stream, path, dlq, cp, trigger=NOW)
        if ends:
            q.awaitTermination()
        else:
            with pytest.raises(Exception, match="lost"):
                q.awaitTermination()
    good, bad = sinks.read_table(spark, path), sinks.read_table(spark, dlq)
    assert good.count() == 20 and bad.count() == 10 and {r["load"] for r in good.collect()} == {r["load"] for r in bad.collect()}


def test_two_queries_write_one_table(spark, replay, tmp_path):
    stream = replay([(0, "click")], [(1, "click")])
    for name in ("a", "b"):
        sinks.write_events(stream, str(tmp_path / "t"), str(tmp_path / name), trigger=NOW).awaitTermination()
    sinks.write_events(frame(spark, W, (2, "click")), str(tmp_path / "t"))
    assert sinks.read_table(spark, str(tmp_path / "t")).count() == 5
    with pytest.raises(ValueError):
        sinks.write_events(stream, str(tmp_path / "t"))


@pytest.mark.parametrize("split", [False, True])
def test_a_new_checkpoint_at_an_old_path_keeps_all_rows(spark, replay, tmp_path, split):
    """Batch numbers begin anew, loads' names don't; how the path is spelled doesn't matter."""
    path, dlq, cp = str(tmp_path / "t"), str(tmp_path / "dlq"), str(tmp_path / "cp")
    first = [(i, "click" if i % 2 else "unheard_of") for i in range(7)]
    stream = replay(first, [(20 + i, "click") for i in range(3)])

    def run(checkpoint, df):
        started = sinks.write_split(df, path, dlq, checkpoint, trigger=NOW) if split else sinks.write_events(df, path, checkpoint, trigger=NOW)
        started.awaitTermination()

    run(cp, stream.where(F.col("event_time") < F.lit(at(W, 10))))
    shutil.rmtree(cp)
    run(cp + "/", stream.where(F.col("event_time") >= F.lit(at(W, 10))))
    run(cp, stream.where(F.col("event_time") >= F.lit(at(W, 10))))  # the same query goes on: nothing is new
    rows = sinks.read_table(spark, path).count() + (sinks.read_table(spark, dlq).count() if split else 0)
    assert rows == 10


def test_a_days_loads_become_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for i in range(4):
        sinks.write_events(frame(spark, W, (i, "click"), (86_400 + i, "click"), *[(10 + i, "search")] * (i == 3)), path)
    want = sorted(map(str, dicts(sinks.read_table(spark, path).drop("load", "ingested_at"))))

    def same_rows():
        assert sorted(map(str, dicts(sinks.read_table(spark, path).drop("load", "ingested_at")))) == want

    with monkeypatch.context() as m:  # broken after the rows are written, before they are logged
        m.setattr(sinks, "_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.rewrite_day(spark, path, "2026-07-02")
    same_rows()
    with monkeypatch.context() as m:  # and after they are logged, before the old ones go
        m.setattr(sinks, "_replaced", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.rewrite_day(spark, path, "2026-07-02")
    same_rows()
    assert sinks.rewrite_day(spark, path, "2026-07-02") is None  # done; what was left goes now
    same_rows()
    assert len(list((tmp_path / "t" / "event_date=2026-07-02").glob("load=*"))) == 1 and len(list((tmp_path / "t" / "event_date=2026-07-03").glob("load=*"))) == 4
    sinks.write_events(frame(spark, W, (50, "click")), path)
    assert sinks.rewrite_day(spark, path, "2026-07-02") and sinks.read_table(spark, path).count() == len(want) + 1


def test_series_and_visitors_of_a_stream(spark, replay, tmp_path):
    events = sorted(EVENTS, key=lambda e: e[0])
    for name, build in (("series", lambda d: olap.timeseries(d, W, "2026-08-01", "5m")), ("visitors", lambda d: olap.unique_visitors(d, W, "2026-08-01", "5m"))):
        path = tmp_path / name
        path.mkdir()
        got = drained(spark, build(replay(events[:90], events[90:], [LAST])), f"s_{name}", path) if name == "series" else drained(spark, build(spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))), f"s_{name}", path)
        got = got.where(F.col("bucket") < F.lit(at(W, 86_400)))
        same(got, build(frame(spark, W, *events)).select(got.columns))
    with pytest.raises(ValueError):
        olap.unique_visitors(spark.readStream.schema(EVENT).parquet(str(tmp_path / "in")), W, "2026-08-01", exact=True)


def test_observed_rows(spark, replay, tmp_path):
    q = streaming.observe_source(replay([(0, "click"), (1, "click")])).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")).trigger(**NOW).start()
    q.awaitTermination()
    assert sum(p.observedMetrics["source"].rows for p in q.recentProgress if "source" in p.observedMetrics) == 2


def test_snapshots(spark, replay, tmp_path):
    seen = []
    q = streaming.start_snapshots(replay([(0, "click"), (1, "click")]), lambda d: d.agg(F.count("*").alias("n")), lambda d, n: seen.append(d.first()), str(tmp_path / "cp"), trigger=NOW)
    q.awaitTermination()
    assert seen[0]["n"] == 2 and seen[0]["snapshot_time"] is not None


def test_enrich_per_batch(spark, replay, tmp_path):
    seen = []
    read = lambda s: s.createDataFrame([("1", "toys", 2.0)], PRODUCT)
    q = streaming.enrich_per_batch(replay([(0, "click", "/", {"product_id": "1"})]), read, lambda d, n: seen.extend(dicts(d)), str(tmp_path / "cp"), trigger=NOW)
    q.awaitTermination()
    assert [r["product_category"] for r in seen] == ["toys"]
