"""The driver's tables as the event model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The given event types, as the model's. Fixed values.
TYPES = {"view": "page_view", "click": "add_to_cart", "signup": "checkout_start", "purchase": "purchase", "error": "search"}
DEVICES, SYSTEMS, BROWSERS = ("desktop", "mobile", "tablet"), ("windows", "macos", "android"), ("chrome", "firefox")
PLACES = (("US", "New York"), ("DE", "Berlin"), ("FR", "Paris"))


def _pick(values, n) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events.parquet as click events. Times stay without zone; ingested_at is up to 2.5 s after them."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.col("event_type")
    mapped = F.coalesce(*[F.when(kind == a, F.lit(b)) for a, b in TYPES.items()])
    k = F.regexp_extract("props", r"(\d+)", 1)
    n = F.col("event_id")
    late = F.expr("make_dt_interval(0, 0, 0, cast((event_id % 2500) / 1000 as decimal(18, 6)))")
    return raw.select(
        n.cast("string").alias("event_id"), mapped.alias("event_type"), F.concat(F.lit("anon-"), F.col("user_id").cast("string")).alias("anonymous_id"),
        F.when(kind.isin("signup", "purchase"), F.concat(F.lit("user-"), F.col("user_id").cast("string"))).alias("user_id"), F.col("ts").alias("event_time"), F.concat(F.lit("/product/"), k).alias("path"),
        F.when(kind != "error", k).alias("product_id"), F.when(kind == "click", F.col("value")).alias("price"), F.when(kind == "purchase", F.col("value")).alias("revenue"),
        F.struct(_pick(DEVICES, n).alias("type"), _pick(SYSTEMS, n).alias("os"), _pick(BROWSERS, n).alias("browser")).alias("device"),
        F.struct(_pick([p[0] for p in PLACES], n).alias("country"), _pick([p[1] for p in PLACES], n).alias("city")).alias("geo"), (F.col("ts") + late).alias("ingested_at"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part.parquet's even keys, so that some product ids are unknown."""
    return spark.read.parquet(f"{sf_dir}/part.parquet").where("p_partkey % 2 = 0").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"))
