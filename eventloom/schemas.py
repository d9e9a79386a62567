"""The records of the event model, one StructType each."""

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

#: The event types known. Fixed values.
EVENT_TYPES = ("page_view", "click", "search", "add_to_cart", "remove_from_cart", "checkout_start", "purchase", "login", "logout")
#: The conversion funnel's stages, first to last. Fixed values.
FUNNEL = ("page_view", "add_to_cart", "checkout_start", "purchase")

#: Sizes and delays of the rollups. Fixed values.
WINDOW, WINDOW_GRACE = "1 minute", "5 seconds"
SESSION_GAP, SESSION_GRACE = "30 minutes", "1 minute"
TOP_N, SNAPSHOT_EVERY = 10, "3 seconds"
ALPHA, THRESHOLD_K, WARMUP = 0.2, 3.0, 5
LOOKBACK_HOURS, FUNNEL_SECONDS = 24, 1800
TTL_DAYS, LATENCY_WINDOW_S, LATENCY_CAP_MS = 30, 60, 2000


def _of(required: dict, optional: dict | None = None, order: list[str] | None = None) -> StructType:
    fields = {k: StructField(k, t, False) for k, t in required.items()} | {k: StructField(k, t, True) for k, t in (optional or {}).items()}
    return StructType([fields[k] for k in order or fields])


_S, _L, _D, _T = StringType(), LongType(), DoubleType(), TimestampType()

DEVICE = _of({"type": _S, "os": _S, "browser": _S})
GEO = _of({"country": _S, "city": _S})

CLICK_EVENT = _of(
    {"event_id": _S, "event_type": _S, "anonymous_id": _S, "event_time": _T, "path": _S, "device": DEVICE, "geo": GEO},
    {"user_id": _S, "referrer": _S, "utm_source": _S, "utm_campaign": _S, "product_id": _S, "price": _D, "revenue": _D, "user_agent": _S},
    ["event_id", "event_type", "anonymous_id", "user_id", "event_time", "path", "referrer", "utm_source", "utm_campaign", "product_id", "price", "revenue", "device", "geo", "user_agent"],
)
PRODUCT = _of({"id": _S, "category": _S, "price": _D})
_FLAT = [f for f in CLICK_EVENT.fields if f.name not in ("device", "geo")]
_FLAT_GROUPS = [StructField(f"{g}_{f.name}", f.dataType, False) for g, s in (("device", DEVICE), ("geo", GEO)) for f in s.fields]
EVENT_ROW = StructType([*_FLAT, *_FLAT_GROUPS, StructField("ingested_at", _T, True)])
ENRICHED_EVENT = StructType([*_FLAT, *_FLAT_GROUPS, StructField("product_category", _S, True), StructField("product_ref_price", _D, True)])
MINUTE_METRICS = _of({"window_start": _T, "window_end": _T, "events": _L, "page_views": _L, "add_to_cart": _L, "checkout_start": _L, "purchases": _L, "revenue": _D})
PAGE_COUNT = _of({"path": _S, "views": _L})
PAGE_TOP_N = _of({"window_start": _T, "window_end": _T, "entries": ArrayType(PAGE_COUNT, False)})
SESSION_SUMMARY = _of(
    {"session_id": _S, "anonymous_id": _S, "session_start": _T, "session_end": _T, "duration_ms": _L, "events": _L, "page_views": _L, "add_to_cart": _L, "checkout_start": _L, "purchases": _L, "revenue": _D, "entry_path": _S, "converted": BooleanType()},
    {"user_id": _S},
    ["session_id", "anonymous_id", "user_id", "session_start", "session_end", "duration_ms", "events", "page_views", "add_to_cart", "checkout_start", "purchases", "revenue", "entry_path", "converted"],
)
FUNNEL_SNAPSHOT = _of({"snapshot_time": _T, "views": _L, "add_to_cart": _L, "checkout_start": _L, "purchases": _L, "view_to_cart_rate": _D, "cart_to_checkout_rate": _D, "checkout_to_purchase_rate": _D, "overall_conversion_rate": _D})
ACTIVE_SNAPSHOT = _of({"snapshot_time": _T, "active_sessions": _L, "window_seconds": _L})
ANOMALY_ALERT = _of({"alert_time": _T, "observed": _L, "baseline_mean": _D, "baseline_stddev": _D, "z_score": _D, "threshold_k": _D, "direction": _S, "baseline_samples": _L})
