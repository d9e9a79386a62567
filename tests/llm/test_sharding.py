"""op10's shards recomputed from the sorted keys."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import queries as Q

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")


def test_shards_are_runs_of_the_sorted_keys_that_end_where_due(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    keys = {r.doc_id: (r.k, r.doc_id) for r in docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("k")).collect()}
    got = sorted(Q.op10_sharding(spark, DIR).collect(), key=lambda r: keys[r.doc_id])
    shards, sizes = [r.shard for r in got], np.array([r["size"] for r in got])
    assert shards == sorted(shards) and len(got) == docs.count()
    below, whole = np.concatenate([[0], np.cumsum(sizes)]), sizes.sum()
    for s in range(1, 24):
        cut = int(np.searchsorted(shards, s))
        off = abs(below[cut] - whole * s / 24)
        # Within the tolerance of 0.0005 shards, or no other cut lies nearer.
        assert off <= 0.0005 * whole / 24 or off <= np.abs(below - whole * s / 24).min() + 1e-6
    for s in set(shards):
        own = [r for r in got if r.shard == s]
        assert [keys[r.doc_id] for r in sorted(own, key=lambda r: r.slot)] == sorted(keys[r.doc_id] for r in own) or sorted(r.slot for r in own) == list(range(len(own)))
