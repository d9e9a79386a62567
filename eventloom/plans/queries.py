"""The registered queries of the event operators, each with SQL that must give the same rows.

All read whole tables; ranges and instants are fixed, so that results don't depend on the clock.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions import columns as C
from eventloom.functions.params import bucket, in_range, of_type, preset_range
from eventloom.operators import anomaly, funnel, olap, rollups, sketches, views
from eventloom.operators.enrich import enrich
from eventloom.sources import sinks
from eventloom.sources.adapter import clicks, products
from eventloom.sources.events import decode_events, load_dimension, read_events
from eventloom.sources.shared import new_folder

FROM, TO, AS_OF = "2024-01-08T00:00:00", "2024-01-22T00:00:00", datetime(2024, 1, 30)
DAY, HALF_DAY = 86_400, "12 hours"

EV = r"""
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS n,
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' WHEN 'signup' THEN 'checkout_start' WHEN 'purchase' THEN 'purchase' WHEN 'error' THEN 'search' END AS event_type,
    'anon-' || user_id AS anonymous_id, CASE WHEN event_type IN ('signup', 'purchase') THEN 'user-' || user_id END AS user_id, ts AS event_time,
    '/product/' || regexp_extract(props, '(\d+)', 1) AS path, CASE WHEN event_type <> 'error' THEN regexp_extract(props, '(\d+)', 1) END AS product_id,
    CASE WHEN event_type = 'click' THEN value END AS price, CASE WHEN event_type = 'purchase' THEN value END AS revenue,
    ['desktop', 'mobile', 'tablet'][event_id % 3 + 1] AS device_type, ['windows', 'macos', 'android'][event_id % 3 + 1] AS device_os, ['chrome', 'firefox'][event_id % 2 + 1] AS device_browser,
    ['US', 'DE', 'FR'][event_id % 3 + 1] AS geo_country, ['New York', 'Berlin', 'Paris'][event_id % 3 + 1] AS geo_city, ts + to_milliseconds(CAST(event_id % 2500 AS DOUBLE)) AS ingested_at
  FROM events)"""
_RANGE = f"event_time >= TIMESTAMP '{FROM.replace('T', ' ')}' AND event_time < TIMESTAMP '{TO.replace('T', ' ')}'"
_COUNTS = """count(*) AS events, count(*) FILTER (event_type = 'page_view') AS page_views, count(*) FILTER (event_type = 'add_to_cart') AS add_to_cart,
    count(*) FILTER (event_type = 'checkout_start') AS checkout_start, count(*) FILTER (event_type = 'purchase') AS purchases,
    round(coalesce(sum(CASE WHEN event_type = 'purchase' THEN coalesce(revenue, 0) END), 0), 2) AS revenue"""
_METRICS = f"m AS (SELECT date_trunc('minute', event_time) AS window_start, date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end, {_COUNTS} FROM ev GROUP BY 1, 2)"
_PAGES = """v AS (SELECT time_bucket(INTERVAL 12 HOURS, event_time, TIMESTAMP '1970-01-01') AS window_start, path, count(*) AS views FROM ev WHERE event_type = 'page_view' GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY views DESC, path) AS rank FROM v)"""
_STAGE = "CASE event_type WHEN 'page_view' THEN 0 WHEN 'add_to_cart' THEN 1 WHEN 'checkout_start' THEN 2 WHEN 'purchase' THEN 3 ELSE -1 END"
_FURTHEST = f"f AS (SELECT anonymous_id, max({_STAGE}) AS stage FROM ev WHERE {_STAGE} >= 0 GROUP BY 1)"
_REACHED = (
    "s AS (SELECT count(*) FILTER (stage >= 0) AS views, count(*) FILTER (stage >= 1) AS add_to_cart, count(*) FILTER "
    "(stage >= 2) AS checkout_start, count(*) FILTER (stage >= 3) AS purchases FROM f)"
)
_VOLUME = """c AS (SELECT date_trunc('hour', event_time) AS b, count(*) AS x FROM ev GROUP BY 1),
g AS (SELECT unnest(generate_series((SELECT min(b) FROM c), (SELECT max(b) FROM c), INTERVAL 1 HOUR)) AS b),
vol AS (SELECT g.b AS bucket, coalesce(c.x, 0) AS observed, row_number() OVER (ORDER BY g.b) AS i FROM g LEFT JOIN c ON g.b = c.b)"""


def _levels_sql(window: int, where: str = "TRUE") -> str:
    """Independent of the operator's form: from each first step, the earliest later step in turn."""
    sql = f"""st AS (SELECT anonymous_id AS a, CAST(floor(epoch(event_time)) AS BIGINT) AS t, {_STAGE} AS s FROM ev WHERE {where}),
h1 AS (SELECT DISTINCT a, t AS t0, t FROM st WHERE s = 0)"""
    for i in (1, 2, 3):
        sql += f""",
h{i + 1} AS (SELECT h.a, h.t0, min(n.t) AS t FROM h{i} h JOIN st n ON n.a = h.a AND n.s = {i} AND n.t >= h.t AND n.t <= h.t0 + {window} GROUP BY 1, 2)"""
    return sql + """,
lv AS (SELECT u.a AS anonymous_id, CASE WHEN u.a IN (SELECT a FROM h4) THEN 4 WHEN u.a IN (SELECT a FROM h3) THEN 3 WHEN u.a IN (SELECT a FROM h2) THEN 2 WHEN u.a IN (SELECT a FROM h1) THEN 1 ELSE 0 END AS level FROM (SELECT DISTINCT a FROM st) u)"""


_REPORT = """n AS (SELECT count(*) FILTER (level >= 1) AS n1, count(*) FILTER (level >= 2) AS n2, count(*) FILTER (level >= 3) AS n3, count(*) FILTER (level >= 4) AS n4 FROM lv),
rep AS (SELECT 'page_view' AS stage, n1 AS visitors, n1 AS top, NULL AS prev FROM n UNION ALL SELECT 'add_to_cart', n2, n1, n1 FROM n UNION ALL SELECT 'checkout_start', n3, n1, n2 FROM n UNION ALL SELECT 'purchase', n4, n1, n3 FROM n)"""
_REPORT_OUT = (
    "SELECT stage, visitors, round(CASE WHEN top = 0 THEN 0.0 ELSE visitors / top END, 6) AS conversion_from_top, round(CASE "
    "WHEN prev IS NULL THEN 1.0 WHEN prev = 0 THEN 0.0 ELSE visitors / prev END, 6) AS conversion_from_prev FROM rep"
)


def _sessions_sql(minutes: int) -> str:
    return f"""WITH {EV}, l AS (SELECT *, CASE WHEN event_time - lag(event_time) OVER w > INTERVAL {minutes} MINUTE OR lag(event_time) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM ev WINDOW w AS (PARTITION BY anonymous_id ORDER BY event_time, n)),
k AS (SELECT *, sum(new) OVER (PARTITION BY anonymous_id ORDER BY event_time, n) AS sid FROM l)
SELECT anonymous_id || ':' || (epoch_us(min(event_time)) // 1000) AS session_id, anonymous_id, arg_min(user_id, n) FILTER (user_id IS NOT NULL) AS user_id, min(event_time) AS session_start, max(event_time) AS session_end,
  (epoch_us(max(event_time)) // 1000) - (epoch_us(min(event_time)) // 1000) AS duration_ms, {_COUNTS}, arg_min(path, n) AS entry_path, count(*) FILTER (event_type = 'purchase') > 0 AS converted FROM k GROUP BY anonymous_id, sid"""


def _ewma_sql(k: float) -> str:
    return f"""WITH RECURSIVE {EV}, {_VOLUME},
e AS (
  SELECT 1 AS i, CAST(observed AS DOUBLE) AS mean, CAST(0 AS DOUBLE) AS var, bucket, observed, CAST(NULL AS DOUBLE) AS m0, CAST(NULL AS DOUBLE) AS sd0, CAST(0 AS BIGINT) AS n0 FROM vol WHERE i = 1
  UNION ALL
  SELECT vol.i, e.mean + 0.2 * (vol.observed - e.mean), 0.8 * (e.var + 0.2 * (vol.observed - e.mean) * (vol.observed - e.mean)), vol.bucket, vol.observed, e.mean, greatest(sqrt(e.var), sqrt(greatest(e.mean, 1.0))), e.n0 + 1 FROM e JOIN vol ON vol.i = e.i + 1)
SELECT bucket AS alert_time, observed, round(m0, 6) AS baseline_mean, round(sd0, 6) AS baseline_stddev, round((observed - m0) / sd0, 6) AS z_score, CAST({k} AS DOUBLE) AS threshold_k,
  CASE WHEN observed >= m0 THEN 'spike' ELSE 'drop' END AS direction, n0 AS baseline_samples FROM e WHERE n0 >= 5 AND abs((observed - m0) / sd0) >= {k}"""


def _rounded(df: DataFrame, *names: str, to: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, to) for n in names})


def _long(topn: DataFrame) -> DataFrame:
    rows = topn.select("window_start", F.posexplode("entries").alias("p", "e"))
    return rows.select("window_start", (F.col("p") + 1).cast("long").alias("rank"), "e.path", "e.views")


def _metrics(s, d) -> DataFrame:
    return _rounded(rollups.minute_metrics(clicks(s, d)), "revenue", to=2)


def _snapshot(s, d) -> DataFrame:
    return _rounded(funnel.funnel_snapshot(clicks(s, d)), "view_to_cart_rate", "cart_to_checkout_rate", "checkout_to_purchase_rate", "overall_conversion_rate")


def _sessions(s, d, gap) -> DataFrame:
    return _rounded(rollups.sessionize(clicks(s, d), gap), "revenue", to=2)


def _report(s, d, window, from_=FROM, to=TO) -> DataFrame:
    return _rounded(funnel.funnel_report(clicks(s, d), from_, to, window), "conversion_from_top", "conversion_from_prev")


def _alerts(s, d, k) -> DataFrame:
    return _rounded(anomaly.ewma_alerts(rollups.volume_buckets(clicks(s, d), "1 hour"), k=k), "baseline_mean", "baseline_stddev", "z_score")


def _decoded(s, d, bad: bool) -> DataFrame:
    """props as JSON with one field; every seventh record is broken on the way."""
    raw = s.read.parquet(f"{d}/events.parquet")
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{broken "), "props")).otherwise(F.col("props"))
    from pyspark.sql.types import LongType, StructField, StructType

    found = decode_events(raw.select("event_id", text.alias("value")), StructType([StructField("k", LongType(), False)]))
    return found[1] if bad else found[0]


def _timed(s, d) -> DataFrame:
    raw = s.read.parquet(f"{d}/events.parquet")
    n = F.col("event_id")
    early = F.lit("1969-12-31 23:59:59").cast("timestamp_ntz")
    rows = raw.select("event_id", F.when(n % 3 == 0, None).when(n % 3 == 1, early).otherwise(F.col("ts")).alias("own"), F.when(n % 2 == 0, F.col("ts") + F.expr("INTERVAL 1 SECOND")).otherwise(early).alias("broker"), (F.col("ts") + F.expr("INTERVAL 2 SECONDS")).alias("other"))
    return C.with_event_time(rows, "own", "broker", "other").select("event_id", "event_time")


def _dimension(s, d) -> DataFrame:
    """lineitem as a log of its parts' prices; the last ship date wins, ties by the order; some parts are deleted last."""
    log = s.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_partkey").alias("id"), F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("updated"), F.when(F.col("l_linenumber") < 6, F.col("l_extendedprice")).alias("price"))
    return load_dimension(log, "id", "updated", ("price",))


def _reasons(s, d) -> DataFrame:
    n = F.col("event_id").cast("long")
    rows = clicks(s, d).withColumn("anonymous_id", F.when(n % 11 != 0, F.col("anonymous_id"))).withColumn("event_type", F.when(n % 13 == 0, F.lit("unheard_of")).otherwise(F.col("event_type"))).withColumn("revenue", F.when(n % 17 == 0, -F.col("revenue")).otherwise(F.col("revenue")))
    return sinks.with_reason(rows).groupBy("reason").agg(F.count("*").alias("events"))


def _latency(s, d, exact: bool) -> DataFrame:
    return olap.latency_profile(clicks(s, d), 7 * DAY, 2000, datetime(2024, 1, 20), exact)


def _preset_sql(unit: str, n: int, start: str) -> str:
    return (
        f"WITH {EV} SELECT time_bucket(INTERVAL {n} {unit}, event_time, TIMESTAMP '1970-01-01') AS bucket, event_type, count(*) "
        f"AS events FROM ev WHERE event_time >= TIMESTAMP '{start}' AND event_time < TIMESTAMP '2024-01-20' GROUP BY 1, "
        "2"
    )


def _read(s, d) -> DataFrame:
    return read_events(s, f"{d}/events.parquet", schema="event_id long, ts timestamp_ntz, user_id long, event_type string")


def _written(s, d) -> DataFrame:
    """The event table as it was written, and two of its days read back."""
    path = new_folder(s, "events")
    sinks.write_events(clicks(s, d), path)
    days = in_range(sinks.read_table(s, path), "2024-01-09", "2024-01-11")
    return days.groupBy(F.to_date("event_time").cast("string").alias("day"), "event_type").agg(F.count("*").alias("events"), F.count_distinct("anonymous_id").alias("visitors"))


def _sketched(s, d) -> DataFrame:
    """Each day's exact visitors, and whether the sketch lies within five of its standard deviations."""
    exact = olap.unique_visitors(clicks(s, d), FROM, TO, "day", exact=True)
    sketch = olap.unique_visitors(clicks(s, d), FROM, TO, "day").withColumnRenamed("unique_visitors", "about")
    near = F.abs(F.col("about") - F.col("unique_visitors")) <= F.greatest(F.lit(2.0), 5 * 0.02 * F.col("unique_visitors"))
    return exact.join(sketch, "bucket", "left").select("bucket", "unique_visitors", F.coalesce(near, F.lit(False)).alias("within"))


def _stored(s: SparkSession, rollup: DataFrame) -> DataFrame:
    """A rollup as it is read back from where it was written."""
    path = new_folder(s, "rollup")
    rollup.write.parquet(path)
    return s.read.parquet(path)


def _visitors_of_rollup(s, d) -> DataFrame:
    """Each day's exact visitors, and whether the estimate from stored minutes lies within five standard errors of a sketch."""
    exact = olap.unique_visitors(clicks(s, d), FROM, TO, "day", exact=True)
    rollup = _stored(s, sketches.visitor_sketches(clicks(s, d)))
    about = sketches.visitors_from_sketches(rollup, FROM, TO, "day").withColumnRenamed("unique_visitors", "about")
    near = F.abs(F.col("about") - F.col("unique_visitors")) <= F.greatest(F.lit(2.0), 5 * 0.01625 * F.col("unique_visitors"))
    return exact.join(about, "bucket", "left").select("bucket", "unique_visitors", F.coalesce(near, F.lit(False)).alias("within"))


def _latency_of_rollup(s, d) -> DataFrame:
    """From stored minutes: exact counts, and whether percentiles lie among the values of one hundredth of the ranks around the exact ones."""
    rows = clicks(s, d)
    about = sketches.latency_from_sketches(_stored(s, sketches.latency_sketches(rows)), "2024-01-13", "2024-01-20")
    of = in_range(olap.on_time(rows), "2024-01-13", "2024-01-20", "ingested_at").select(olap.latency_ms().alias("ms"))
    ends = of.agg(*[F.percentile("ms", min(1.0, max(0.0, q / 100 + x))).alias(f"{side}{q}") for q in (50, 95, 99) for side, x in (("low", -0.01), ("high", 0.01))])
    near = [F.col(f"p{q}").between(F.floor(f"low{q}"), F.ceil(f"high{q}")) for q in (50, 95, 99)]
    return about.join(ends, F.lit(True)).select("samples", "max_ms", "avg_ms", (near[0] & near[1] & near[2]).alias("within"))


def _near_percentiles(s, d) -> DataFrame:
    """Whether the approximate percentiles lie among the values of a thousandth of the ranks around the exact ones, to a millisecond."""
    rows = olap.on_time(clicks(s, d).where(F.col("ingested_at").between(F.lit("2024-01-13 00:00:00.000001").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz")))).select(olap.latency_ms().alias("ms"))
    ends = rows.agg(*[F.percentile("ms", q / 100 + x).alias(f"{side}{q}") for q in (50, 95, 99) for side, x in (("low", -0.001), ("high", 0.001))])
    about = _latency(s, d, False)
    near = [F.col(f"p{q}").between(F.floor(f"low{q}"), F.ceil(f"high{q}")) for q in (50, 95, 99)]
    return about.join(ends, F.lit(True)).select("samples", "max_ms", "avg_ms", (near[0] & near[1] & near[2]).alias("within"))


def _preset(s, d, key: str) -> DataFrame:
    start, end, step = preset_range(key, datetime(2024, 1, 20))
    return olap.timeseries(clicks(s, d), start, end, {"5 minutes": "5m", "1 hour": "hour", "1 day": "day"}[step])


def _topn_view(s, d) -> DataFrame:
    rows = views.topn_view(rollups.topn_pages(clicks(s, d), 10, HALF_DAY)).select("windowStart", "windowEnd", F.posexplode("pages").alias("p", "e"))
    return rows.select("windowStart", "windowEnd", (F.col("p") + 1).cast("long").alias("rank"), "e.path", "e.views")


_ACTIVE = "l AS (SELECT anonymous_id, max(event_time) AS t FROM ev GROUP BY 1), x AS (SELECT max(t) AS now FROM l)"
_SERIES = f"ts AS (SELECT date_trunc('hour', event_time) AS bucket, event_type, count(*) AS events FROM ev WHERE {_RANGE} GROUP BY 1, 2)"


def _series(s, d) -> DataFrame:
    return olap.timeseries(clicks(s, d), FROM, TO, "hour")


Query = Callable[[SparkSession, str], DataFrame]

#: name -> (query, SQL or None)
REGISTERED: dict[str, tuple[Query, str | None]] = {
    "s1_read_events": (_read, "SELECT event_id, ts, user_id, event_type FROM events"),
    "s2_decode_good": (lambda s, d: _decoded(s, d, False), r"SELECT event_id, CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k FROM events WHERE event_id % 7 <> 0"),
    "s2_decode_bad": (lambda s, d: _decoded(s, d, True), "SELECT event_id, '{broken ' || props AS value FROM events WHERE event_id % 7 = 0"),
    "s3_event_time": (_timed, "SELECT event_id, CASE WHEN event_id % 3 = 2 THEN ts WHEN event_id % 2 = 0 THEN ts + INTERVAL 1 SECOND ELSE ts + INTERVAL 2 SECOND END AS event_time FROM events"),
    "s4_load_dimension": (_dimension, (
        "SELECT id, price FROM (SELECT l_partkey AS id, CASE WHEN l_linenumber < 6 THEN l_extendedprice END AS price, row_number() "
        "OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS r FROM lineitem) "
        "WHERE r = 1 AND price IS NOT NULL"
    )),
    "s5_event_rows": (lambda s, d: sinks.as_rows(clicks(s, d)).groupBy(F.col("event_date").cast("string").alias("event_date"), "event_type", "device_type").agg(F.count("*").alias("events"), F.max("ingested_at").alias("last_ingested")), (
        f"WITH {EV} SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date, event_type, device_type, count(*) AS "
        "events, max(ingested_at) AS last_ingested FROM ev GROUP BY 1, 2, 3"
    )),
    "s5_written_table": (_written, (
        f"WITH {EV} SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS day, event_type, count(*) AS events, count(DISTINCT "
        "anonymous_id) AS visitors FROM ev WHERE event_time >= TIMESTAMP '2024-01-09' AND event_time < TIMESTAMP '2024-01-11' "
        "GROUP BY 1, 2"
    )),
    "s6_reject_reasons": (_reasons, (
        f"WITH {EV} SELECT CASE WHEN n % 11 = 0 THEN 'missing anonymous_id' WHEN n % 13 = 0 THEN 'unknown event_type' WHEN "
        "n % 17 = 0 AND revenue > 0 THEN 'negative amount' END AS reason, count(*) AS events FROM ev GROUP BY 1"
    )),
    "s7_rollup_messages": (lambda s, d: sinks.as_messages(rollups.minute_metrics(clicks(s, d)).select("window_start", "events"), "window").select("key", F.get_json_object("value", "$.events").cast("long").alias("events")), (
        f"WITH {EV} SELECT CAST(epoch_ms(date_trunc('minute', event_time)) AS VARCHAR) AS key, count(*) AS events FROM ev "
        "GROUP BY 1"
    )),
    "s8_apply_retention": (lambda s, d: sinks.apply_retention(clicks(s, d), AS_OF, 10).select("event_id", "event_time"), f"WITH {EV} SELECT event_id, event_time FROM ev WHERE event_time >= TIMESTAMP '2024-01-20'"),
    "p1_flatten": (lambda s, d: C.flatten(clicks(s, d)), f"WITH {EV} SELECT * EXCLUDE (n) FROM ev"),
    "p3_page_views": (lambda s, d: C.page_views(clicks(s, d)).select("event_id", "path"), f"WITH {EV} SELECT event_id, path FROM ev WHERE event_type = 'page_view'"),
    "p4_in_range": (lambda s, d: in_range(clicks(s, d), FROM, TO).select("event_id", "event_time"), f"WITH {EV} SELECT event_id, event_time FROM ev WHERE {_RANGE}"),
    "p5_of_type": (lambda s, d: of_type(clicks(s, d), "purchase").select("event_id", "revenue"), f"WITH {EV} SELECT event_id, revenue FROM ev WHERE event_type = 'purchase'"),
    "p6_preset_7d": (lambda s, d: _preset(s, d, "7d"), (
        f"WITH {EV} SELECT date_trunc('hour', event_time) AS bucket, event_type, count(*) AS events FROM ev WHERE event_time "
        ">= TIMESTAMP '2024-01-13' AND event_time < TIMESTAMP '2024-01-20' GROUP BY 1, 2"
    )),
    "p6_preset_24h": (lambda s, d: _preset(s, d, "24h"), _preset_sql("minute", 5, "2024-01-19")),
    "p6_preset_30d": (lambda s, d: _preset(s, d, "30d"), _preset_sql("day", 1, "2023-12-21")),
    "p6_preset_unknown": (lambda s, d: _preset(s, d, "no such range"), _preset_sql("minute", 5, "2024-01-19")),
    "p7_bucket_5m": (lambda s, d: clicks(s, d).select("event_id", bucket("event_time", " 5Min ").alias("bucket")), f"WITH {EV} SELECT event_id, time_bucket(INTERVAL 5 MINUTES, event_time) AS bucket FROM ev"),
    "p7_bucket_day": (lambda s, d: clicks(s, d).select("event_id", bucket("event_time", "1d").alias("bucket")), f"WITH {EV} SELECT event_id, CAST(date_trunc('day', event_time) AS TIMESTAMP) AS bucket FROM ev"),
    "p8_funnel_stage": (lambda s, d: clicks(s, d).select("event_id", C.funnel_stage().alias("stage")), f"WITH {EV} SELECT event_id, CAST({_STAGE} AS INTEGER) AS stage FROM ev"),
    "p10_output_key": (lambda s, d: C.with_output_key(rollups.sessionize(clicks(s, d), HALF_DAY), "session").select("key", "events"), f"SELECT session_id AS key, events FROM ({_sessions_sql(720)})"),
    "p11_metrics_view": (lambda s, d: views.metrics_view(_metrics(s, d)), (
        f"WITH {EV}, {_METRICS} SELECT window_start AS \"windowStart\", window_end AS \"windowEnd\", events, page_views "
        "AS \"pageViews\", add_to_cart AS \"addToCart\", checkout_start AS \"checkoutStart\", purchases, revenue FROM m"
    )),
    "p11_funnel_view": (lambda s, d: views.funnel_view(funnel.funnel_snapshot(clicks(s, d)).select("views", "add_to_cart", "checkout_start", "purchases")), (
        f"WITH {EV}, {_FURTHEST}, {_REACHED} SELECT views, add_to_cart AS \"addToCart\", checkout_start AS \"checkoutStart\", "
        "purchases FROM s"
    )),
    "p11_topn_view": (_topn_view, f"WITH {EV}, {_PAGES} SELECT window_start AS \"windowStart\", window_start + INTERVAL 12 HOURS AS \"windowEnd\", rank, path, views FROM r WHERE rank <= 10"),
    "p11_alerts_view": (lambda s, d: views.alerts_view(_alerts(s, d, 1.0)), (
        "SELECT alert_time AS \"alertTime\", observed, baseline_mean AS \"baselineMean\", baseline_stddev AS \"baselineStddev\", "
        "z_score AS \"zScore\", threshold_k AS \"thresholdK\", direction, baseline_samples AS \"baselineSamples\" FROM "
        f"({_ewma_sql(1.0)})"
    )),
    "p11_active_view": (lambda s, d: views.active_view(rollups.active_visitors(clicks(s, d), "6 hours")), (
        f"WITH {EV}, {_ACTIVE} SELECT any_value(now) AS \"snapshotTime\", count(*) FILTER (t > now - INTERVAL 6 HOURS) AS "
        "\"activeSessions\", CAST(21600 AS BIGINT) AS \"windowSeconds\" FROM l, x"
    )),
    "p12_on_time": (lambda s, d: olap.on_time(clicks(s, d)).select("event_id", olap.latency_ms().alias("ms")), (
        f"WITH {EV} SELECT event_id, epoch_us(ingested_at) // 1000 - epoch_us(event_time) // 1000 AS ms FROM ev WHERE epoch_us(ingested_at) "
        "// 1000 - epoch_us(event_time) // 1000 BETWEEN 0 AND 2000"
    )),
    "j1_enrich": (lambda s, d: enrich(clicks(s, d), products(s, d)).select("event_id", "event_type", "product_id", "product_category", "product_ref_price", "device_type", "geo_country"), (
        f"WITH {EV} SELECT event_id, event_type, product_id, p_type AS product_category, p_retailprice AS product_ref_price, "
        "device_type, geo_country FROM ev LEFT JOIN part ON p_partkey % 2 = 0 AND CAST(p_partkey AS VARCHAR) = product_id"
    )),
    "a1_minute_metrics": (_metrics, f"WITH {EV}, {_METRICS} SELECT * FROM m"),
    "a2_page_views_per_window": (lambda s, d: rollups.page_views_per_window(clicks(s, d), HALF_DAY).select(F.col("window.start").alias("window_start"), "path", "views"), f"WITH {EV}, {_PAGES} SELECT window_start, path, views FROM v"),
    "a3_topn_pages": (lambda s, d: _long(rollups.topn_pages(clicks(s, d), 10, HALF_DAY)), f"WITH {EV}, {_PAGES} SELECT window_start, rank, path, views FROM r WHERE rank <= 10"),
    "a4_sessions_30m": (lambda s, d: _sessions(s, d, "30 minutes"), _sessions_sql(30)),
    "a4_sessions_6h": (lambda s, d: _sessions(s, d, "6 hours"), _sessions_sql(360)),
    "a5_furthest_stage": (lambda s, d: funnel.furthest_stage(clicks(s, d)), f"WITH {EV}, {_FURTHEST} SELECT anonymous_id, CAST(stage AS INTEGER) AS stage FROM f"),
    "a6_funnel_snapshot": (_snapshot, (
        f"WITH {EV}, {_FURTHEST}, {_REACHED} SELECT views, add_to_cart, checkout_start, purchases, round(CASE WHEN views "
        "= 0 THEN 0.0 ELSE add_to_cart / views END, 6) AS view_to_cart_rate, round(CASE WHEN add_to_cart = 0 THEN 0.0 ELSE "
        "checkout_start / add_to_cart END, 6) AS cart_to_checkout_rate, round(CASE WHEN checkout_start = 0 THEN 0.0 ELSE "
        "purchases / checkout_start END, 6) AS checkout_to_purchase_rate, round(CASE WHEN views = 0 THEN 0.0 ELSE purchases "
        "/ views END, 6) AS overall_conversion_rate FROM s"
    )),
    "a7_active_visitors": (lambda s, d: rollups.active_visitors(clicks(s, d), "6 hours"), (
        f"WITH {EV}, l AS (SELECT anonymous_id, max(event_time) AS t FROM ev GROUP BY 1), x AS (SELECT max(t) AS now FROM "
        "l) SELECT any_value(now) AS snapshot_time, count(*) FILTER (t > now - INTERVAL 6 HOURS) AS active_sessions, CAST(21600 "
        "AS BIGINT) AS window_seconds FROM l, x"
    )),
    "a8_volume_buckets": (lambda s, d: rollups.volume_buckets(clicks(s, d), "1 hour"), f"WITH {EV}, {_VOLUME} SELECT bucket, observed FROM vol"),
    "a9_ewma_alerts": (lambda s, d: _alerts(s, d, 3.0), _ewma_sql(3.0)),
    "a9_ewma_alerts_k1": (lambda s, d: _alerts(s, d, 1.0), _ewma_sql(1.0)),
    "a10_window_funnel_30m": (lambda s, d: funnel.window_funnel(clicks(s, d)), f"WITH {EV}, {_levels_sql(1800)} SELECT anonymous_id, CAST(level AS INTEGER) AS level FROM lv"),
    "a10_window_funnel_1d": (lambda s, d: funnel.window_funnel(clicks(s, d), window_seconds=DAY), f"WITH {EV}, {_levels_sql(DAY)} SELECT anonymous_id, CAST(level AS INTEGER) AS level FROM lv"),
    "a11_funnel_report_30m": (lambda s, d: _report(s, d, 1800), f"WITH {EV}, {_levels_sql(1800, _RANGE)}, {_REPORT} {_REPORT_OUT}"),
    "a11_funnel_report_1d": (lambda s, d: _report(s, d, DAY), f"WITH {EV}, {_levels_sql(DAY, _RANGE)}, {_REPORT} {_REPORT_OUT}"),
    "a12_unique_visitors": (lambda s, d: olap.unique_visitors(clicks(s, d), FROM, TO, "hour", exact=True), (
        f"WITH {EV} SELECT date_trunc('hour', event_time) AS bucket, count(DISTINCT anonymous_id) AS unique_visitors FROM "
        f"ev WHERE {_RANGE} GROUP BY 1"
    )),
    "a12_unique_visitors_approx": (lambda s, d: _sketched(s, d), (
        f"WITH {EV} SELECT CAST(date_trunc('day', event_time) AS TIMESTAMP) AS bucket, count(DISTINCT anonymous_id) AS unique_visitors, "
        f"TRUE AS within FROM ev WHERE {_RANGE} GROUP BY 1"
    )),
    "a13_retention": (lambda s, d: olap.retention(clicks(s, d).where(F.col("event_time") < F.lit("2024-01-03").cast("timestamp_ntz")), [F.col("event_time") < F.lit("2024-01-02").cast("timestamp_ntz"), (F.col("event_time") >= F.lit("2024-01-02").cast("timestamp_ntz")) & (F.col("event_time") < F.lit("2024-01-03").cast("timestamp_ntz"))]), (
        f"WITH {EV}, b AS (SELECT anonymous_id, max(CASE WHEN event_time < TIMESTAMP '2024-01-02' THEN 1 ELSE 0 END) AS "
        "c0, max(CASE WHEN event_time >= TIMESTAMP '2024-01-02' AND event_time < TIMESTAMP '2024-01-03' THEN 1 ELSE 0 END) "
        "AS c1 FROM ev GROUP BY 1) SELECT CAST(sum(c0) AS BIGINT) AS r0, CAST(sum(c0 * c1) AS BIGINT) AS r1 FROM b"
    )),
    "a12_visitors_from_sketches": (
        _visitors_of_rollup,
        f"WITH {EV} SELECT CAST(date_trunc('day', event_time) AS TIMESTAMP) AS bucket, count(DISTINCT anonymous_id) AS unique_visitors, TRUE AS within FROM ev WHERE {_RANGE} GROUP BY 1",
    ),
    "a16_latency_from_sketches": (
        _latency_of_rollup,
        f"WITH {EV}, x AS (SELECT epoch_us(ingested_at) // 1000 - epoch_us(event_time) // 1000 AS ms FROM ev WHERE ingested_at >= TIMESTAMP '2024-01-13' AND ingested_at < TIMESTAMP '2024-01-20') "
        "SELECT count(*) AS samples, max(ms) AS max_ms, round(avg(ms), 1) AS avg_ms, TRUE AS within FROM x WHERE ms BETWEEN 0 AND 2000",
    ),
    "a14_timeseries": (_series, f"WITH {EV}, {_SERIES} SELECT * FROM ts"),
    "a14_timeseries_purchase": (lambda s, d: olap.timeseries(clicks(s, d), FROM, TO, "1d", "purchase"), (
        f"WITH {EV} SELECT CAST(date_trunc('day', event_time) AS TIMESTAMP) AS bucket, event_type, count(*) AS events FROM "
        f"ev WHERE {_RANGE} AND event_type = 'purchase' GROUP BY 1, 2"
    )),
    "a15_top_pages": (lambda s, d: olap.top_pages(clicks(s, d), FROM, TO, 8), (
        f"WITH {EV} SELECT path, count(*) AS views FROM ev WHERE {_RANGE} AND event_type = 'page_view' GROUP BY 1 ORDER "
        "BY 2 DESC, 1 LIMIT 8"
    )),
    "a16_latency_profile": (lambda s, d: _latency(s, d, True), (
        f"WITH {EV}, x AS (SELECT epoch_us(ingested_at) // 1000 - epoch_us(event_time) // 1000 AS ms FROM ev WHERE ingested_at "
        "> TIMESTAMP '2024-01-13' AND ingested_at <= TIMESTAMP '2024-01-20') SELECT count(*) AS samples, CAST(round(quantile_cont(ms, "
        "0.5)) AS BIGINT) AS p50, CAST(round(quantile_cont(ms, 0.95)) AS BIGINT) AS p95, CAST(round(quantile_cont(ms, 0.99)) "
        "AS BIGINT) AS p99, max(ms) AS max_ms, round(avg(ms), 1) AS avg_ms FROM x WHERE ms BETWEEN 0 AND 2000"
    )),
    "a16_latency_profile_approx": (_near_percentiles, (
        f"WITH {EV}, x AS (SELECT epoch_us(ingested_at) // 1000 - epoch_us(event_time) // 1000 AS ms FROM ev WHERE ingested_at "
        "> TIMESTAMP '2024-01-13' AND ingested_at <= TIMESTAMP '2024-01-20') SELECT count(*) AS samples, max(ms) AS max_ms, "
        "round(avg(ms), 1) AS avg_ms, TRUE AS within FROM x WHERE ms BETWEEN 0 AND 2000"
    )),
    "a17_profile": (lambda s, d: olap.profile(clicks(s, d)), f"WITH {EV} SELECT count(*) AS events, count(DISTINCT anonymous_id) AS visitors FROM ev"),
    "a18_throughput": (lambda s, d: _rounded(olap.throughput(clicks(s, d), sample="1 hour"), "events_per_second"), (
        f"WITH {EV} SELECT date_trunc('hour', event_time) AS sample_start, count(*) AS events, round(count(*) / 3600, 6) "
        "AS events_per_second FROM ev GROUP BY 1"
    )),
    "a18_mean_throughput": (lambda s, d: _rounded(olap.mean_throughput(olap.throughput(clicks(s, d), sample="1 hour")), "mean_events_per_second"), (
        f"WITH {EV}, t AS (SELECT count(*) / 3600 AS r FROM ev GROUP BY date_trunc('hour', event_time)) SELECT count(*) "
        "AS samples, round(avg(r), 6) AS mean_events_per_second FROM t"
    )),
    "a19_total_series": (lambda s, d: olap.total_series(_series(s, d)), f"WITH {EV}, {_SERIES} SELECT bucket, CAST(sum(events) AS BIGINT) AS events FROM ts GROUP BY 1"),
    "a20_event_types": (lambda s, d: olap.event_types(_series(s, d)), f"WITH {EV}, {_SERIES} SELECT DISTINCT event_type FROM ts"),
    "a21_live_gauges": (lambda s, d: views.live_gauges(_metrics(s, d)), (
        f"WITH {EV}, {_METRICS} SELECT window_start, CAST(floor(events / 60 + 0.5) AS BIGINT) AS events_per_sec, purchases "
        "AS conversions_per_min FROM m ORDER BY window_start DESC LIMIT 1"
    )),
    "a22_kpis": (lambda s, d: _rounded(funnel.kpis(_report(s, d, DAY)), "cart_rate", "conversion_rate"), (
        f"WITH {EV}, {_levels_sql(DAY, _RANGE)}, {_REPORT} SELECT n1 AS view_visitors, n2 AS cart_visitors, n4 AS purchase_visitors, "
        "round(CASE WHEN n1 = 0 THEN 0.0 ELSE n2 / n1 END, 6) AS cart_rate, round(CASE WHEN n1 = 0 THEN 0.0 ELSE n4 / n1 "
        "END, 6) AS conversion_rate FROM n"
    )),
    "w5_share_of_leader": (lambda s, d: _rounded(views.share_of_leader(rollups.rank_pages(rollups.page_views_per_window(clicks(s, d), HALF_DAY))), "share").select("window_start", F.col("rank").cast("long").alias("rank"), "path", "share"), (
        f"WITH {EV}, {_PAGES} SELECT window_start, rank, path, round(views / first(views) OVER (PARTITION BY window_start "
        "ORDER BY rank), 6) AS share FROM r WHERE rank <= 10"
    )),
    "w6_share_of_views": (lambda s, d: _rounded(views.share_of_views(funnel.funnel_snapshot(clicks(s, d))), "share"), (
        f"WITH {EV}, {_FURTHEST}, {_REACHED}, x AS (SELECT 'views' AS stage, views AS visitors, views FROM s UNION ALL SELECT "
        "'add_to_cart', add_to_cart, views FROM s UNION ALL SELECT 'checkout_start', checkout_start, views FROM s UNION "
        "ALL SELECT 'purchases', purchases, views FROM s) SELECT stage, visitors, round(CASE WHEN views > 0 THEN visitors "
        "/ views ELSE 0.0 END, 6) AS share FROM x"
    )),
    "l5_recent_metrics": (lambda s, d: views.recent_metrics(_metrics(s, d)), f"WITH {EV}, {_METRICS} SELECT * FROM m ORDER BY window_start DESC LIMIT 30"),
    "l6_recent_alerts": (lambda s, d: views.recent_alerts(_alerts(s, d, 1.0)), f"SELECT * FROM ({_ewma_sql(1.0)}) ORDER BY alert_time DESC LIMIT 20"),
}


def queries() -> dict[str, Query]:
    return {k: q for k, (q, _) in REGISTERED.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in REGISTERED.items() if sql}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.funnel_report(clicks(spark, sf_dir), "2024-01-01", "2024-02-01", DAY)
