"""In-memory events for tests."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

EVENT = StructType([StructField(n, t) for n, t in (("event_id", StringType()), ("event_type", StringType()), ("anonymous_id", StringType()), ("user_id", StringType()), ("event_time", TimestampType()), ("path", StringType()), ("product_id", StringType()), ("price", DoubleType()), ("revenue", DoubleType()))])


def at(text, seconds=0.0):
    return datetime.fromisoformat(text) + timedelta(seconds=seconds)


def rows(base, *events):
    """Events as (seconds after base, type[, path[, fields]])."""
    out = []
    for i, (s, kind, *more) in enumerate(events):
        path = more[0] if more else "/"
        extra = more[1] if len(more) > 1 else {}
        row = {"event_id": f"e{i:05d}", "event_type": kind, "anonymous_id": "anon-1", "user_id": None, "event_time": at(base, s), "path": path, "product_id": None, "price": None, "revenue": None} | extra
        out.append(tuple(row[f.name] for f in EVENT.fields))
    return out


def frame(spark, base, *events):
    found = rows(base, *events)
    df = spark.createDataFrame(found, EVENT)
    return df.withColumn("device", F.struct(F.lit("desktop").alias("type"), F.lit("macos").alias("os"), F.lit("chrome").alias("browser"))).withColumn("geo", F.struct(F.lit("US").alias("country"), F.lit("New York").alias("city")))


def dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]
