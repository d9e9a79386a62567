"""Writing events and rollups.

The event table and the dead letters are written in loads, and each has a log of the loads that are whole, in the folder ``_loads`` beside its data: a
file for each load, made after its rows. Readers take the rows of logged loads only (read_table()), so what a failed job left behind is not seen.
A micro-batch's load is named by its query's own id, which Spark makes anew with each new checkpoint, and the batch's number. So a batch that is
tried again replaces what it wrote before, and no query replaces what another one wrote, whatever its checkpoint's path.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.columns import flatten, known_type, with_output_key
from eventloom.schemas import TTL_DAYS

SORT_KEY = ("event_type", "event_time", "anonymous_id")
LOG = "_loads"
LOG_ENTRY = "load string, day string, replaces array<string>"


def as_rows(df: DataFrame) -> DataFrame:
    """Events as the event table holds them: flat, with the time of ingestion and the day they are stored under."""
    flat = flatten(df)
    if "ingested_at" not in flat.columns:
        flat = flat.withColumn("ingested_at", F.current_timestamp())
    return flat.withColumn("event_date", F.to_date("event_time"))


def _files(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _put(rows: DataFrame, path: str, *by: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _write(rows: DataFrame, path: str, load: str) -> None:
    # AQE divides a large day and joins small ones by size; within files rows are sorted for min/max pruning.
    dealt = rows.withColumn("load", F.lit(load)).hint("rebalance", "event_date")
    _put(dealt.sortWithinPartitions("event_date", *SORT_KEY), path, "event_date", "load")


def _commit(spark: SparkSession, path: str, load: str, day: str | None = None, replaces: list[str] | None = None) -> bool:
    """Logs a load, by one renaming; False if it is logged already."""
    target, fs = _files(spark, f"{path.rstrip('/')}/{LOG}/{load}.json")
    if fs.exists(target):
        return False
    draft, _ = _files(spark, f"{path.rstrip('/')}/{LOG}/.{load}-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"load": load, "day": day, "replaces": replaces}).encode()))
    out.close()
    done = fs.rename(draft, target)
    if not done:
        fs.delete(draft, False)
    return done


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table's logged loads, less those of loads that rewrite_day() has replaced on that day."""
    rows = spark.read.parquet(path)
    log = spark.read.schema(LOG_ENTRY).json(f"{path.rstrip('/')}/{LOG}/*.json")
    rows = rows.join(log.select("load"), "load", "left_semi")
    if "event_date" in rows.columns:
        gone = log.where("replaces IS NOT NULL").select(F.to_date("day").alias("event_date"), F.explode("replaces").alias("load"))
        rows = rows.join(gone, ["event_date", "load"], "left_anti")
    return rows


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query when it made the checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/query/metadata").first()[0])["id"]


def _by_load(df: DataFrame, checkpoint: str | None, trigger: dict | None, put: Callable[[DataFrame, str], None]):
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint")

    def run(batch: DataFrame, batch_id: int) -> None:
        put(batch, f"q{_query_id(batch.sparkSession, checkpoint)}b{batch_id}")

    return df.writeStream.foreachBatch(run).option("checkpointLocation", f"{checkpoint.rstrip('/')}/query").trigger(**(trigger or {"processingTime": "1 second"})).start()


def write_events(df: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None):
    """Appends events to a table partitioned by day and load, and sorted within its files. A stream needs ``checkpoint`` and gives its running query.

    A batch DataFrame is one load; of a stream each micro-batch is. A load is seen whole or not at all, and each event is in the table once.
    """
    if df.isStreaming:

        def put(batch: DataFrame, load: str) -> None:
            _write(as_rows(batch), path, load)
            _commit(batch.sparkSession, path, load)

        return _by_load(df, checkpoint, trigger, put)
    load = f"b{uuid.uuid4().hex}"
    _write(as_rows(df), path, load)
    _commit(df.sparkSession, path, load)
    return None


def rewrite_day(spark: SparkSession, path: str, day: date | str) -> str | None:
    """Rewrites a day's many loads in one, sorted as a whole; its name, or None if there were fewer than two. One at a time for a day.

    The log's entry for the new load names those that it replaces, so readers see the day's rows once at any moment, whether this ends or not; what
    a broken try left is not logged. Replaced files go after that. Jobs that began to read before then may find them gone.
    """
    day = str(day)
    rows = read_table(spark, path).where(F.col("event_date") == F.lit(day).cast("date"))
    old = sorted(r[0] for r in rows.select("load").distinct().collect())
    load = f"d{day}-{hashlib.sha256(' '.join(old).encode()).hexdigest()[:32]}"
    made = len(old) > 1
    if made:
        _write(rows.drop("load"), path, load)
        made = _commit(spark, path, load, day, old)
    for name in _replaced(spark, path, day):
        where, fs = _files(spark, f"{path.rstrip('/')}/event_date={day}/load={name}")
        fs.delete(where, True)
    return load if made else None


def _replaced(spark: SparkSession, path: str, day: str) -> list[str]:
    """Also those that an earlier try had no time to delete."""
    log = spark.read.schema(LOG_ENTRY).json(f"{path.rstrip('/')}/{LOG}/*.json")
    return [r[0] for r in log.where(F.col("day") == day).select(F.explode("replaces")).collect()]


#: Why a row is refused: reason and the test that it fails, first failure first.
def default_rules() -> list[tuple[str, Column]]:
    return [
        ("missing event_id", F.col("event_id").isNotNull()),
        ("missing anonymous_id", F.col("anonymous_id").isNotNull()),
        ("missing event_time", F.col("event_time").isNotNull()),
        ("unknown event_type", known_type()),
        ("negative amount", F.coalesce(F.col("revenue") >= 0, F.lit(True)) & F.coalesce(F.col("price") >= 0, F.lit(True))),
    ]


def with_reason(df: DataFrame, rules: list[tuple[str, Column]] | None = None) -> DataFrame:
    """Adds ``reason``: the first rule that a row fails, or null."""
    return df.withColumn("reason", F.coalesce(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules or default_rules()]))


def split_invalid(df: DataFrame, rules: list[tuple[str, Column]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rejected rows carry their reason."""
    judged = with_reason(df, rules)
    return judged.where("reason IS NULL").drop("reason"), judged.where("reason IS NOT NULL")


def write_split(df: DataFrame, path: str, rejected_path: str, checkpoint: str, rules=None, trigger: dict | None = None):
    """A stream's valid rows into the event table and the rest, with reasons, into a dead-letter folder partitioned by load; each row is in one of them
    once, as in write_events()."""

    def put(batch: DataFrame, load: str) -> None:
        spark, batch = batch.sparkSession, batch.persist()
        valid, rejected = split_invalid(batch, rules)
        _write(as_rows(valid), path, load)
        _put(rejected.withColumn("load", F.lit(load)), rejected_path, "load")
        for written in (path, rejected_path):
            _commit(spark, written, load)
        batch.unpersist()

    return _by_load(df, checkpoint, trigger, put)


def as_messages(df: DataFrame, kind: str | None = None) -> DataFrame:
    """(key, value) with the row as JSON, as a topic takes it. kind: the key of with_output_key()."""
    rows = with_output_key(df, kind) if kind else df.withColumn("key", F.lit(None).cast("string"))
    return rows.select("key", F.to_json(F.struct(*df.columns)).alias("value"))


def write_rollup(df: DataFrame, name: str, sink: dict, mode: str = "append", checkpoint: str | None = None, kind: str | None = None, trigger: dict | None = None):
    """Starts a rollup's query. sink: {"format": "parquet"|"memory"|"kafka"|..., and its options}. A topic gets keyed JSON.

    With a checkpoint the file sink is exactly-once; the Kafka sink is at-least-once.
    """
    options = dict(sink)
    fmt = options.pop("format")
    out = as_messages(df, kind) if fmt == "kafka" else df
    writer = out.writeStream.queryName(name).format(fmt).outputMode(mode).options(**options)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start() if trigger else writer.start()


def apply_retention(df: DataFrame, as_of: datetime, days: int = TTL_DAYS, time_col: str = "event_time") -> DataFrame:
    """Rows no older than ``days`` days."""
    least = F.lit((as_of - timedelta(days=days)).isoformat(sep=" ")).cast(dict(df.dtypes)[time_col])
    return df.where(F.col(time_col) >= least)


def drop_expired(spark: SparkSession, path: str, as_of: datetime, days: int = TTL_DAYS) -> list[str]:
    """Deletes the table's days that lie whole before the limit; the names of those that went."""
    least = (as_of - timedelta(days=days)).date().isoformat()
    root, fs = _files(spark, path)
    gone = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("event_date=") and name.split("=", 1)[1] < least:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)
