"""Events with their product's category and list price."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import flatten

#: A dimension of at most so many rows goes to every executor; a larger one is joined by an exchange.
BROADCAST_ROWS = 500_000


def sized(dimension: DataFrame, at_most: int = BROADCAST_ROWS) -> DataFrame:
    """The dimension with a broadcast hint if a count shows that it is small."""
    return F.broadcast(dimension) if dimension.limit(at_most + 1).count() <= at_most else dimension


def enrich(events: DataFrame, products: DataFrame) -> DataFrame:
    """Flattened events with product_category and product_ref_price; both null if product_id is null or unknown. Stateless on a stream."""
    flat = flatten(events)
    known = sized(products.select(F.col("id").alias("_id"), F.col("category").alias("product_category"), F.col("price").alias("product_ref_price")))
    return flat.join(known, flat.product_id == F.col("_id"), "left").drop("_id")
