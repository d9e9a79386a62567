"""Column expressions of the event model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventloom.schemas import EVENT_TYPES, FUNNEL


def funnel_stage(event_type: str | Column = "event_type") -> Column:
    """0 to 3 for the funnel's event types, -1 for others."""
    kind = F.col(event_type) if isinstance(event_type, str) else event_type
    found = F.when(kind == FUNNEL[0], 0)
    for i, name in enumerate(FUNNEL[1:], 1):
        found = found.when(kind == name, i)
    return found.otherwise(-1)


def known_type(event_type: str = "event_type") -> Column:
    return F.coalesce(F.col(event_type).isin(*EVENT_TYPES), F.lit(False))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 where whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def event_time(event_col: str, ingest_col: str, fallback: str | None = None) -> Column:
    """The event's own time if there and not before 1970, else the broker's if not before 1970, else ``fallback``."""
    from_1970 = lambda c: F.when(F.unix_millis(F.col(c).cast("timestamp")) >= 0, F.col(c))
    return F.coalesce(from_1970(event_col), from_1970(ingest_col), *([F.col(fallback)] if fallback else []))


def with_event_time(df: DataFrame, event_col: str, ingest_col: str, fallback: str | None = None, into: str = "event_time") -> DataFrame:
    """Adds the event time. The third choice, a partition's own time, has no column in Spark: the caller names one."""
    return df.withColumn(into, event_time(event_col, ingest_col, fallback))


def seconds(time_col: str) -> Column:
    return F.unix_seconds(F.col(time_col).cast("timestamp"))


def millis(time_col: str | Column) -> Column:
    return F.unix_millis((F.col(time_col) if isinstance(time_col, str) else time_col).cast("timestamp"))


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Fields of structs as columns named struct, ``sep``, field; at every depth."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StructType):
            out += [F.col(f"`{f.name}`.`{g.name}`").alias(f"{f.name}{sep}{g.name}") for g in f.dataType.fields]
        else:
            out.append(F.col(f"`{f.name}`"))
    flat = df.select(out)
    return flatten(flat, sep) if any(isinstance(f.dataType, StructType) for f in flat.schema.fields) else flat


def page_views(df: DataFrame) -> DataFrame:
    return df.where(F.col("event_type") == FUNNEL[0])


def with_output_key(df: DataFrame, kind: str) -> DataFrame:
    """The key under which a rollup's row is published: "window" or "session"."""
    if kind == "window":
        return df.withColumn("key", millis("window_start").cast("string"))
    if kind == "session":
        return df.withColumn("key", F.col("session_id"))
    raise ValueError(f"unknown kind of key: {kind}")


def percent_text(value: Column) -> Column:
    return F.format_string("%.1f%%", value * 100)


def compact_text(value: Column) -> Column:
    """1234 as 1.2K, millions as M."""
    short = lambda by, mark: F.concat(F.regexp_replace(F.format_string("%.1f", value / by), r"\.0$", ""), F.lit(mark))
    return F.when(value >= 1e6, short(1e6, "M")).when(value >= 1e3, short(1e3, "K")).otherwise(value.cast("long").cast("string"))


def type_label(event_type: Column) -> Column:
    return F.initcap(F.replace(event_type, F.lit("_"), F.lit(" ")))
