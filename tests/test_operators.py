"""Literal cases for every batch operator, and those that ranges, ties and empty inputs make."""

from datetime import datetime

import pytest
from helpers import EVENT, at, dicts, frame
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.functions import columns as C
from eventloom.functions.params import in_range, of_type, parse_interval, preset_range, require_positive, resolve_range
from eventloom.operators import anomaly, funnel, olap, rollups, sketches, views
from eventloom.operators.enrich import enrich

W, S = "2026-07-02T10:00:00", "2026-07-04T10:00:00"


def test_minute_metrics(spark):
    df = frame(spark, W, (1, "page_view"), (2, "page_view", "/product/1"), (3, "add_to_cart"), (4, "checkout_start"), (5, "purchase", "/", {"revenue": 49.99}), (6, "click"), (130, "page_view"), (131, "purchase", "/", {"revenue": None}))
    first, second = dicts(C.with_output_key(rollups.minute_metrics(df), "window").orderBy("window_start"))
    assert first == {"window_start": at(W), "window_end": at(W, 60), "events": 6, "page_views": 2, "add_to_cart": 1, "checkout_start": 1, "purchases": 1, "revenue": 49.99, "key": "1782986400000"}
    assert (second["purchases"], second["revenue"]) == (1, 0.0)


def test_topn_pages(spark):
    events = [(0, "page_view", "/a")] * 5 + [(1, "page_view", "/b")] * 3 + [(2, "page_view", "/c"), (10, "add_to_cart", "/a"), (130, "page_view", "/next")]
    first, _ = dicts(rollups.topn_pages(frame(spark, W, *events)).orderBy("window_start"))
    assert [(e["path"], e["views"]) for e in first["entries"]] == [("/a", 5), ("/b", 3), ("/c", 1)]


def test_topn_cuts_and_breaks_ties_by_path(spark):
    events = [(1, "page_view", f"/{c}") for c in "zyxwvutsrqpon"]
    (row,) = dicts(rollups.topn_pages(frame(spark, W, *events)))
    assert [e["path"] for e in row["entries"]] == [f"/{c}" for c in "nopqrstuvw"]


def test_session(spark):
    df = frame(spark, S, (0, "page_view", "/"), (30, "login", "/login", {"user_id": "user-7"}), (60, "page_view", "/product/1"), (90, "add_to_cart"), (120, "checkout_start"), (150, "purchase", "/", {"revenue": 42.5}))
    (r,) = dicts(rollups.sessionize(df))
    assert r["session_id"] == "anon-1:1783159200000" and r["user_id"] == "user-7" and r["session_end"] == at(S, 150)
    assert (r["duration_ms"], r["events"], r["page_views"], r["add_to_cart"], r["checkout_start"], r["purchases"], r["revenue"]) == (150_000, 6, 2, 1, 1, 1, 42.5)
    assert r["entry_path"] == "/" and r["converted"] is True


def test_session_gap_bridge_and_boundary(spark):
    two = dicts(rollups.sessionize(frame(spark, S, (0, "page_view", "/"), (20, "page_view", "/product/1"), (31 * 60, "page_view", "/deals"))).orderBy("session_start"))
    assert [(r["entry_path"], r["events"], r["converted"]) for r in two] == [("/", 2, False), ("/deals", 1, False)]
    assert rollups.sessionize(frame(spark, S, (0, "click"), (1800, "click"))).count() == 1
    assert rollups.sessionize(frame(spark, S, (0, "click"), (1800.000001, "click"))).count() == 2
    assert rollups.sessionize(frame(spark, S, (0, "click"), (50 * 60, "click"), (25 * 60, "click"))).count() == 1
    assert rollups.sessionize(frame(spark, "2026-07-04T23:50:00", (0, "click"), (1200, "click"))).count() == 1


def test_sessions_partition_the_events(spark):
    events = [(i * 977 % 40_000, "click", "/", {"anonymous_id": f"v{i % 7}"}) for i in range(300)]
    assert rollups.sessionize(frame(spark, S, *events)).agg(F.sum("events")).first()[0] == 300


def test_enrichment(spark):
    products = spark.createDataFrame([("sku-1001", "electronics", 199.99)], schemas.PRODUCT)
    df = frame(spark, W, (0, "page_view", "/", {"product_id": "sku-1001"}), (1, "page_view", "/", {"product_id": "sku-9999"}), (2, "page_view"))
    a, b, c = dicts(enrich(df, products).orderBy("event_id"))
    assert (a["product_category"], a["product_ref_price"], a["device_type"], a["geo_country"]) == ("electronics", 199.99, "desktop", "US")
    assert (b["product_id"], b["product_category"], b["product_ref_price"]) == ("sku-9999", None, None)
    assert (c["product_id"], c["product_category"]) == (None, None)


def _people(spark, *people):
    return frame(spark, W, *[(i, kind, "/", {"anonymous_id": who}) for who, kinds in people for i, kind in enumerate(kinds)])


def test_live_funnel(spark):
    v, a, c, p = schemas.FUNNEL
    (r,) = dicts(funnel.funnel_snapshot(_people(spark, ("A", [v, v, a, c, p]), ("B", [v, a]), ("C", [v]), ("D", ["search"]))))
    assert [r[x] for x in ("views", "add_to_cart", "checkout_start", "purchases")] == [3, 2, 1, 1]
    assert [r[x] for x in ("view_to_cart_rate", "cart_to_checkout_rate", "checkout_to_purchase_rate", "overall_conversion_rate")] == [2 / 3, 0.5, 1.0, 1 / 3]
    (z,) = dicts(funnel.funnel_snapshot(_people(spark, ("Z", [p]))))
    assert [z["views"], z["purchases"], z["overall_conversion_rate"]] == [1, 1, 1.0]
    (n,) = dicts(funnel.funnel_snapshot(_people(spark).limit(0)))
    assert n["views"] == 0 and n["view_to_cart_rate"] == 0.0


def test_active_visitors(spark):
    who = lambda s, x: (s, "click", "/", {"anonymous_id": x})
    (r,) = dicts(rollups.active_visitors(frame(spark, W, who(0, "A"), who(30, "B"), who(45, "A"), who(60, "C"))))
    assert (r["active_sessions"], r["window_seconds"], r["snapshot_time"]) == (3, 1800, at(W, 60))
    assert rollups.active_visitors(frame(spark, W, who(0, "old"), who(31 * 60, "recent"))).first()["active_sessions"] == 1
    assert rollups.active_visitors(frame(spark, W, who(0, "old"), who(30 * 60, "recent"))).first()["active_sessions"] == 1
    assert rollups.active_visitors(frame(spark, W, who(0, "x")).limit(0)).count() == 0


def _volume(spark, *counts):
    return spark.createDataFrame([(at(W, 60 * i), n) for i, n in enumerate(counts)], "bucket timestamp, observed long")


def test_anomaly(spark):
    (r,) = dicts(anomaly.ewma_alerts(_volume(spark, *[10] * 6, 100)))
    assert (r["observed"], r["direction"], r["baseline_mean"], r["baseline_samples"]) == (100, "spike", 10.0, 6) and r["z_score"] >= 3
    (r,) = dicts(anomaly.ewma_alerts(_volume(spark, *[100] * 6, 0)))
    assert (r["observed"], r["direction"]) == (0, "drop") and r["z_score"] <= -3
    assert anomaly.ewma_alerts(_volume(spark, 10, 200)).count() == 0
    assert anomaly.ewma_alerts(_volume(spark).limit(0)).count() == 0
    # The bucket that alerts moves the baseline: at once after it, as many events are less of a surprise.
    found = dicts(anomaly.ewma_alerts(_volume(spark, *[10] * 6, 100, 100)).orderBy("alert_time"))
    assert found[0]["z_score"] > 25 and all(x["z_score"] < 3 for x in found[1:])


def test_volume_fills_zero_buckets(spark):
    df = frame(spark, W, (1, "click"), (2, "click"), (185, "click"))
    assert [r["observed"] for r in dicts(rollups.volume_buckets(df).orderBy("bucket"))] == [2, 0, 0, 1]
    assert rollups.volume_buckets(df.limit(0)).count() == 0
    keyed = frame(spark, W, (1, "click", "/a"), (130, "click", "/a"), (70, "click", "/b"))
    assert {(r["path"], r["observed"]) for r in dicts(rollups.volume_buckets(keyed, keys=("path",)))} == {("/a", 1), ("/a", 0), ("/b", 1)}


def test_event_time(spark):
    df = spark.createDataFrame([(0, 1782986400000, 999, -1), (1, None, 12345, -1), (2, -100, 777, -1), (3, -100, -1, 42)], "i int, e long, r long, p long")
    df = df.select("i", *[F.timestamp_millis(c).alias(c) for c in "erp"])
    got = [r[0] for r in C.with_event_time(df, "e", "r", "p", "t").orderBy("i").select(F.unix_millis("t")).collect()]
    assert got == [1782986400000, 12345, 777, 42]


def test_olap(spark):
    v, a, c, p = schemas.FUNNEL
    people = {"a": [(v, "/"), (a, "/cart"), (c, "/checkout"), (p, "/thank-you")], "b": [(v, "/"), (a, "/cart"), (c, "/checkout")], "c": [(v, "/"), (a, "/cart")], "d": [(v, "/products")], "e": [(v, "/products")]}
    df = frame(spark, W, *[(i, kind, path, {"anonymous_id": who}) for who, steps in people.items() for i, (kind, path) in enumerate(steps)])
    span = (W, at(W, 3600))
    report = funnel.funnel_report(df, *span, 1800)
    got = dicts(report)
    assert [r["visitors"] for r in got] == [5, 3, 2, 1] and [r["stage"] for r in got] == list(schemas.FUNNEL)
    assert [r["conversion_from_top"] for r in got] == [1, 3 / 5, 2 / 5, 1 / 5] and [r["conversion_from_prev"] for r in got] == [1, 3 / 5, 2 / 3, 1 / 2]
    assert dicts(funnel.kpis(report)) == [{"view_visitors": 5, "cart_visitors": 3, "purchase_visitors": 1, "cart_rate": 0.6, "conversion_rate": 0.2}]
    assert [tuple(r) for r in olap.unique_visitors(df, *span, "hour", exact=True).collect()] == [(at(W), 5)]
    assert olap.unique_visitors(df, *span).first()["unique_visitors"] == 5
    assert [tuple(r) for r in olap.top_pages(df, *span).collect()] == [("/", 3), ("/products", 2)]
    series = olap.timeseries(df, *span, "hour")
    assert [(r["event_type"], r["events"]) for r in series.collect()] == [(a, 3), (c, 2), (v, 5), (p, 1)]
    assert [r["events"] for r in olap.timeseries(df, *span, "hour", "purchase").collect()] == [1]
    assert olap.total_series(series).first()["events"] == 11 and olap.event_types(series).count() == 4
    assert tuple(olap.profile(df).first()) == (11, 5)


def test_funnel_arithmetic(spark):
    levels = spark.createDataFrame([(1, 600), (2, 200), (3, 100), (4, 100)], "level int, n long")
    got = dicts(funnel.report_from_levels(levels, "n"))
    assert [r["visitors"] for r in got] == [1000, 400, 200, 100] and [r["conversion_from_top"] for r in got] == [1, 0.4, 0.2, 0.1] and [r["conversion_from_prev"] for r in got] == [1, 0.4, 0.5, 0.5]
    none = dicts(funnel.report_from_levels(levels.limit(0), "n"))
    assert [r["visitors"] for r in none] == [0] * 4 and [r["conversion_from_prev"] for r in none] == [1.0, 0.0, 0.0, 0.0]


def test_window_funnel_order_and_window(spark):
    v, a, c, p = schemas.FUNNEL

    def level(*steps, window=60):
        df = frame(spark, W, *steps)
        return funnel.window_funnel(df, window_seconds=window).first()["level"]

    assert level((0, a), (1, v)) == 1
    assert level((0, p)) == 0
    assert level((0, v), (10, a), (61, c)) == 2
    assert level((0, v), (60, a)) == 2
    assert level((0, v), (50, v), (100, a), (105, c)) == 3  # the later start counts
    assert level((0.9, a), (0.1, v)) == 2  # the same second counts as in order
    assert level((0, v), (1, c), (2, a), (3, p)) == 2


def test_retention_rule(spark):
    x, y = F.col("path") == "/x", F.col("path") == "/y"
    df = frame(spark, W, (0, "click", "/x"), (1, "click", "/y"), (2, "click", "/y", {"anonymous_id": "only-second"}), (3, "click", "/x", {"anonymous_id": "only-first"}))
    assert tuple(olap.retention(df, [x, y]).first()) == (2, 1)
    assert tuple(olap.retention(df.limit(0), [x, y]).first()) == (0, 0)


def test_parameters():
    for text, step in ((None, "1 hour"), (" ", "1 hour"), ("MINUTE", "1 minute"), ("5m", "5 minutes"), ("5min", "5 minutes"), ("Hour", "1 hour"), ("day", "1 day")):
        assert parse_interval(text) == step
    with pytest.raises(ValueError):
        parse_interval("fortnight")
    with pytest.raises(ValueError):
        require_positive("limit", 0)
    now = datetime(2024, 1, 2)
    assert resolve_range(None, " ", now) == (datetime(2024, 1, 1), now)
    assert resolve_range("2024-01-01T02:00:00+02:00", None, now)[0] == datetime(2024, 1, 1)
    for bad in (("x", None), ("2024-01-03", None)):
        with pytest.raises(ValueError):
            resolve_range(*bad, now)
    assert preset_range("7d", now)[2] == "1 hour" and preset_range("?", now) == preset_range("24h", now)


def test_arguments_are_checked_first(spark):
    df = frame(spark, W, (0, "click"))
    with pytest.raises(ValueError):
        funnel.funnel_report(df, W, None, 0)
    with pytest.raises(ValueError):
        olap.top_pages(df, W, at(W, 9), 0)


def test_range_is_half_open_and_type_filter(spark):
    df = frame(spark, W, (0, "click"), (59, "search"), (60, "click"))
    assert in_range(df, W, at(W, 60)).count() == 2
    assert of_type(df, " ").count() == 3 and of_type(df, "click").count() == 2


def test_views(spark):
    metrics = rollups.minute_metrics(frame(spark, W, *[(i, "page_view") for i in range(50)], (70, "purchase", "/", {"revenue": 1.0})))
    assert views.metrics_view(metrics).columns == ["windowStart", "windowEnd", "events", "pageViews", "addToCart", "checkoutStart", "purchases", "revenue"]
    assert [r["events"] for r in views.recent_metrics(metrics).collect()] == [50, 1]
    assert tuple(views.live_gauges(metrics).first())[1:] == (0, 1)
    ranked = rollups.rank_pages(rollups.page_views_per_window(frame(spark, W, (0, "page_view", "/a"), (1, "page_view", "/a"), (2, "page_view", "/b"))))
    assert [r["share"] for r in views.share_of_leader(ranked).orderBy("rank").collect()] == [1.0, 0.5]
    topn = rollups.topn_pages(frame(spark, W, (0, "page_view", "/a")))
    assert views.topn_view(topn).columns == ["windowStart", "windowEnd", "pages"]
    snap = funnel.funnel_snapshot(_people(spark, ("A", ["page_view", "add_to_cart"]), ("B", ["page_view"])))
    assert [r["share"] for r in views.share_of_views(snap).collect()] == [1.0, 0.5, 0.0, 0.0]
    assert "viewToCartRate" in views.funnel_view(snap).columns
    assert "baselineMean" in views.alerts_view(anomaly.ewma_alerts(_volume(spark, 1))).columns
    text = spark.range(1).select(C.percent_text(F.lit(0.1234)).alias("p"), C.compact_text(F.lit(1234)).alias("c"), C.type_label(F.lit("add_to_cart")).alias("t")).first()
    assert tuple(text) == ("12.3%", "1.2K", "Add To Cart")


def test_latency_and_throughput(spark):
    df = frame(spark, W, *[(i, "click") for i in range(10)]).withColumn("ingested_at", F.col("event_time") + F.expr("INTERVAL 100 MILLISECONDS") * F.col("event_id").substr(2, 5).cast("int"))
    r = olap.latency_profile(df, 60, 800, at(W, 30), exact=True).first()
    assert (r["samples"], r["p50"], r["max_ms"], r["avg_ms"]) == (9, 400, 800, 400.0)
    assert olap.mean_throughput(olap.throughput(df)).first()["mean_events_per_second"] == 1.0


def test_empty_inputs(spark):
    none = spark.createDataFrame([], EVENT)
    for found in (rollups.minute_metrics(none), rollups.topn_pages(none), rollups.sessionize(none), funnel.furthest_stage(none), funnel.window_funnel(none), olap.timeseries(none, W, at(W, 9)), olap.top_pages(none, W, at(W, 9))):
        assert found.count() == 0


def test_visitors_from_stored_sketches(spark, tmp_path):
    """Any range and interval over the buckets, about as from the events; keys, nulls, and a range that cuts a bucket."""
    events = [(i * 61 % 7200, "page_view" if i % 3 else "click", "/", {"anonymous_id": f"v{i % 700}" if i % 50 else None}) for i in range(3000)]
    df = frame(spark, W, *events)
    path = str(tmp_path / "rollup")
    sketches.visitor_sketches(df).write.parquet(path)
    stored = spark.read.parquet(path)
    for interval in ("5m", "hour"):
        want = {r["bucket"]: r["unique_visitors"] for r in olap.unique_visitors(df, W, at(W, 7200), interval, exact=True).collect()}
        got = {r["bucket"]: r["unique_visitors"] for r in sketches.visitors_from_sketches(stored, W, at(W, 7200), interval).collect()}
        assert got.keys() == want.keys() and all(abs(got[b] - n) <= max(2, 0.08 * n) for b, n in want.items())
    part = sketches.visitors_from_sketches(stored, at(W, 600), at(W, 1200), "hour").first()["unique_visitors"]
    assert abs(part - olap.unique_visitors(df, at(W, 600), at(W, 1200), "hour", exact=True).first()["unique_visitors"]) <= 5
    by_type = sketches.visitor_sketches(df, "1 hour", ("event_type",))
    assert {r["event_type"] for r in by_type.collect()} == {"page_view", "click"} and by_type.agg(F.sum("events")).first()[0] == 3000
    assert sketches.visitors_from_sketches(stored.limit(0), W, at(W, 60)).count() == 0
    with pytest.raises(ValueError):
        sketches.visitors_from_sketches(stored, at(W, 1), at(W, 60))


def test_latency_from_stored_sketches(spark):
    df = frame(spark, W, *[(i, "click") for i in range(3000)]).withColumn("ingested_at", F.expr("event_time + make_dt_interval(0, 0, 0, cast(pmod(hash(event_id), 2200) / 1000 as decimal(18, 6)))"))
    stored = sketches.latency_sketches(df)
    got = sketches.latency_from_sketches(stored, W, at(W, 1800)).first()
    ms = sorted(r[0] for r in olap.on_time(df.where(F.col("ingested_at") < F.lit(at(W, 1800)))).select(olap.latency_ms()).collect())
    assert got["samples"] == len(ms) and got["max_ms"] == ms[-1] and abs(got["avg_ms"] - sum(ms) / len(ms)) <= 0.05
    for q in (50, 95, 99):
        assert ms[int(len(ms) * (q / 100 - 0.01))] <= got[f"p{q}"] <= ms[min(len(ms) - 1, int(len(ms) * (q / 100 + 0.01)))]
    none = sketches.latency_from_sketches(stored.limit(0), W, at(W, 60)).first()
    assert none["samples"] == 0 and none["p50"] is None and none["avg_ms"] is None
