"""Reading, judging and writing events."""

from datetime import datetime

from helpers import at, dicts, frame
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.functions.params import in_range
from eventloom.sources import sinks
from eventloom.sources.events import decode_events, load_dimension, read_events

W = "2026-07-02T10:00:00"


def test_decode_keeps_bad_records_apart(spark):
    good = '{"id": "a", "category": "c", "price": 1.5, "extra": 1}'
    raw = spark.createDataFrame([(1, good), (2, "{nonsense"), (3, None), (4, '{"id": "b"}'), (5, "")], "offset long, value string")
    ok, bad = decode_events(raw, schemas.PRODUCT)
    assert dicts(ok) == [{"offset": 1, "id": "a", "category": "c", "price": 1.5}]
    assert sorted(r["offset"] for r in dicts(bad)) == [2, 3, 4, 5] and bad.columns == raw.columns


def test_dimension_takes_the_latest_and_drops_the_deleted(spark):
    log = spark.createDataFrame([("a", 1, "x", 1.0), ("a", 3, "z", 3.0), ("a", 2, "y", 2.0), ("b", 1, "x", 1.0), ("b", 2, None, None), (None, 1, "x", 1.0)], "id string, updated int, category string, price double")
    assert dicts(load_dimension(log)) == [{"id": "a", "category": "z", "price": 3.0}]


def test_split_invalid(spark):
    df = frame(spark, W, (0, "click"), (1, "unheard_of"), (2, "click", "/", {"anonymous_id": None}), (3, "purchase", "/", {"revenue": -1.0}), (4, "unheard_of", "/", {"event_id": None}))
    valid, rejected = sinks.split_invalid(df)
    assert valid.count() == 1 and valid.columns == df.columns
    assert sorted(r["reason"] for r in dicts(rejected)) == ["missing anonymous_id", "missing event_id", "negative amount", "unknown event_type"]


def test_table_is_pruned_and_expires(spark, tmp_path):
    path = str(tmp_path / "events")
    df = frame(spark, W, (0, "page_view"), (1, "click"), (3 * 86_400, "click"), (40 * 86_400, "click"))
    sinks.write_events(df, path)
    table = sinks.read_table(spark, path)
    assert {"device_type", "geo_city", "ingested_at", "event_date"} <= set(table.columns) and table.count() == 4
    part = in_range(table, W, at(W, 86_400))
    assert part.count() == 2
    plan = part._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sinks.apply_retention(table, datetime(2026, 8, 12), 30).count() == 1
    assert sinks.drop_expired(spark, path, datetime(2026, 8, 12), 30) == ["event_date=2026-07-02", "event_date=2026-07-05"]
    assert sinks.read_table(spark, path).count() == 1


def test_messages_are_keyed(spark):
    rows = spark.createDataFrame([(at(W), 3)], "window_start timestamp, events long")
    (m,) = dicts(sinks.as_messages(rows, "window"))
    assert m["key"] == "1782986400000" and '"events":3' in m["value"]


def test_read_events_both_ways(spark, tmp_path):
    path = str(tmp_path / "raw")
    frame(spark, W, (0, "click"), (1, "click")).select("event_id", "event_type", "event_time").write.json(path)
    schema = "event_id string, event_type string, event_time timestamp"
    assert read_events(spark, path, fmt="json", schema=schema).count() == 2
    stream = read_events(spark, path, streaming=True, fmt="json", schema=schema, max_files=1)
    assert stream.isStreaming and stream.columns == ["event_id", "event_type", "event_time"]
    assert F.col("event_id") is not None
