"""Whitening against a dense eigensolver."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import queries as Q
from eventloom.llm.whitening import leading, minres, whitened

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("kind", ["flat", "spread", "flat-large", "rank", "equal", "small", "one"])
def test_leading(kind):
    rng = np.random.default_rng(0)
    d = {"flat-large": 400, "small": 5, "one": 1}.get(kind, 150)
    x = rng.standard_normal((10 if kind == "rank" else 2000, d)) * (np.logspace(0, 3, d) if kind == "spread" else 8)
    v = np.cov(x.T).reshape(d, d)
    if kind == "equal":
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        v = (q * np.repeat(np.linspace(5, 1, d // 3), 3)) @ q.T
    jobs = []
    e, u = leading(lambda c: (jobs.append(1), v @ c)[1], d, 32)
    want = np.linalg.eigvalsh(v)[::-1][:32]
    assert np.abs(e - want).max() <= 1e-13 * want[0] and np.linalg.norm(v @ u - u * e, axis=0).max() <= 1e-12 * want[0]
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-13 and len(jobs) < 200


def test_minres():
    rng = np.random.default_rng(1)
    v = np.cov(rng.standard_normal((200, 30)).T)
    q = np.linalg.qr(rng.standard_normal((30, 3)))[0]
    p = np.eye(30) - q @ q.T
    rhs, shifts = p @ rng.standard_normal((30, 2)), np.array([0.3, 9.0])
    t = minres(lambda c: v @ c, q, shifts, rhs, 60)
    for j in range(2):
        assert np.linalg.norm(p @ (v - shifts[j] * np.eye(30)) @ p @ t[:, j] - rhs[:, j]) < 1e-8


def expected(e, components=32):
    x = np.floor(64 * np.asarray(e, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    w, u = np.linalg.eigh(c.T @ c / n)
    w, u = w[::-1][:components], u[:, ::-1][:, :components]
    return ((n * x - s) ** 2).sum(axis=1), c @ u / np.sqrt(w), w / np.trace(c.T @ c / n)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")
def test_the_query(spark):
    got = Q.op13_whitening(spark, DIR).toPandas().sort_values(["vec_id", "component"])
    rows = spark.read.parquet(f"{DIR}/embeddings.parquet").orderBy("vec_id").collect()
    deviation, w, share = expected([r["embedding"] for r in rows])
    assert list(got.component) == list(range(1, 33)) * len(rows) and set(got.n) == {len(rows)}
    assert list(got.deviation) == list(np.repeat(deviation, 32))
    mine = got.whitened.values.reshape(-1, 32)
    mine = mine * np.sign((mine * w).sum(axis=0))
    assert np.abs(mine - w).max() < 1e-8 and np.allclose(got.explained.values.reshape(-1, 32), share, rtol=1e-9) and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-10


def test_edges(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    odd = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0]), (103, [float("nan")] * 5), (104, [float("inf")] * 5), (105, [1.0] * 4), (None, good[0][1]), (7, good[7][1])]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("x", "v", "w", "n", "component", "deviation")})
    got = whitened(df).toPandas()
    assert len(got) == 42 * 5 and got.n.unique().tolist() == [42] and got.vec_id.isna().sum() == 5
    deviation, w, _ = expected([e for _, e in good] + [good[0][1], good[7][1]])
    mine = got[got.vec_id == 3].sort_values("component")
    assert np.allclose(np.abs(mine.whitened), np.abs(w[3])) and set(mine.deviation) == {deviation[3]}
    assert whitened(df.limit(0)).collect() == [] and whitened(df.where("vec_id = 3")).collect() == []
    assert whitened(df, components=2).select("component").distinct().count() == 2
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], "vec_id long, embedding array<double>")
    assert [r["component"] for r in whitened(flat).where("vec_id = 1").collect()] == [1]  # one dimension is all they have
    with pytest.raises(Exception, match="beyond a long"):
        whitened(spark.createDataFrame([(1, [1e12]), (2, [0.0]), (3, [0.0])], "vec_id long, embedding array<double>")).collect()
