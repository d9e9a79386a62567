"""Reading events and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from eventloom.schemas import CLICK_EVENT


def read_events(spark: SparkSession, source: str | dict, streaming: bool = False, fmt: str = "parquet", schema: StructType = CLICK_EVENT, starting: str = "earliest", max_files: int | None = None) -> DataFrame:
    """Events of a folder (parquet, json), or of a topic with ``fmt`` "kafka" and the connector's options as ``source``.

    ``starting`` is where a new Kafka query begins: "earliest" to process everything, "latest" for live readers. A topic gives its raw records;
    decode_events() takes their value. The Kafka and Avro connectors are separate jars, which this library doesn't ship and its tests don't use.
    """
    if fmt == "kafka":
        reader = (spark.readStream if streaming else spark.read).format("kafka").options(**source)
        return (reader.option("startingOffsets", starting) if streaming or starting == "earliest" else reader).load()
    if streaming:
        reader = spark.readStream.format(fmt).schema(schema)
        return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(source)
    return spark.read.format(fmt).schema(schema).load(source)


def decode_events(df: DataFrame, schema: StructType = CLICK_EVENT, value_col: str = "value", fmt: str = "json", avro_schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad): records whose value decodes, its fields after the record's other columns, and those that don't, as they came.

    A null value is bad. JSON that lacks a required field is bad too; an extra field is not. ``fmt`` "avro" needs the spark-avro jar.
    """
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro

        parsed = df.withColumn("_record", from_avro(F.col(value_col), avro_schema, {"mode": "PERMISSIVE"}))
        ok = F.col("_record").isNotNull()
    else:
        open_schema = StructType([*[f.__class__(f.name, f.dataType, True) for f in schema.fields]]).add("_corrupt", StringType())
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
        parsed = df.withColumn("_record", F.from_json(F.col(value_col).cast("string"), open_schema, options))
        required = [F.col(f"_record.{f.name}").isNotNull() for f in schema.fields if not f.nullable]
        ok = F.col("_record").isNotNull() & F.col("_record._corrupt").isNull()
        for test in required:
            ok &= test
    ok = F.coalesce(ok, F.lit(False))
    others = [c for c in df.columns if c != value_col]
    good = parsed.where(ok).select(*others, *[F.col(f"_record.{f.name}").alias(f.name) for f in schema.fields])
    return good, parsed.where(~ok).select(*df.columns)


def load_dimension(df: DataFrame, key: str = "id", order_col: str = "updated", value_cols: tuple[str, ...] = ("category", "price")) -> DataFrame:
    """The latest row of each key of an upsert log; a latest row whose values are all null deletes its key. Null keys are left out."""
    latest = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*value_cols), order_col).alias("v"))
    gone = F.lit(True)
    for c in value_cols:
        gone = gone & F.col(f"v.{c}").isNull()
    return latest.where(~gone).select(key, *[F.col(f"v.{c}").alias(c) for c in value_cols])
