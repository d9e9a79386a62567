"""Whitening by the leading eigenvectors of the covariance, found by a block Jacobi-Davidson method without forming the covariance.

All that touches the vectors is a product of the covariance with a few columns: each task multiplies its centred rows, and the sums of the tasks
meet in one aggregation. The driver holds columns as long as a vector, as many as the subspace has, which no number of rows changes.

An outer step takes the subspace's Ritz pairs, locks the leading ones whose residual is that of double precision, and widens the subspace by the
solutions of the correction equation for the next ones, (I - QQ')(V - e)(I - QQ') t = -r with Q the locked and the present Ritz vectors. Some
steps of MINRES solve it for all of them at once, so that a step costs one product, a job, however many they are.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import stored

#: Rows of a stored block, in entries; MINRES steps for an outer step; Ritz vectors beyond those wanted; outer steps before it gives up.
BLOCK_ENTRIES, INNER, SPARE, OUTER = 1 << 18, 8, 8, 60
Product = Callable[[np.ndarray], np.ndarray]


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=0))


def _over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(np.broadcast_shapes(a.shape, b.shape)), where=b != 0)


def minres(times: Product, q: np.ndarray, shifts: np.ndarray, rhs: np.ndarray, steps: int) -> np.ndarray:
    """Columns t orthogonal to q with (I - qq')(V - shift)(I - qq') t near their right sides, after ``steps`` of MINRES for all at once."""

    def off(x):
        return x - q @ (q.T @ x)

    v = off(rhs)
    beta = _norms(v)
    v, eta = _over(v, beta), beta
    before, x, w, w_before = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    cos = cos_before = np.ones(v.shape[1])
    sin = sin_before = np.zeros(v.shape[1])
    for _ in range(steps):
        y = off(times(v) - v * shifts)
        alpha = (v * y).sum(axis=0)
        y = y - alpha * v - beta * before
        beta_next = _norms(y)
        beta_next[beta_next <= np.finfo(float).eps * np.abs(alpha)] = 0
        turned = cos * alpha - cos_before * sin * beta
        upper, second = sin * alpha + cos_before * cos * beta, sin_before * beta
        size = np.hypot(turned, beta_next)
        w, w_before = _over(v - second * w_before - upper * w, size), w
        cos_before, sin_before, cos, sin = cos, sin, _over(turned, size), _over(beta_next, size)
        x = x + cos * eta * w
        eta = -sin * eta
        before, v, beta = v, _over(y, beta_next), beta_next
        if not v.any():
            break
    return off(x)


def _new_directions(t: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Orthonormal columns for what t adds to the bases."""
    known = np.hstack(bases)
    room = known.shape[0] - known.shape[1]
    out = _over(t, _norms(t))
    for _ in range(2):
        out = out - known @ (known.T @ out)
        u, s, _ = np.linalg.svd(out, full_matrices=False)
        out = u[:, s > 1e-8 * max(1.0, s[0] if len(s) else 0)][:, :room] if room else u[:, :0]
    return out


def leading(times: Product, size: int, wanted: int, inner: int = INNER, most: int | None = None, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns), the ``wanted`` largest of a symmetric ``size`` x ``size`` matrix known by its products, largest
    first, each with a residual of at most size x 2^-52 times the largest. Raises if that is not reached."""
    wanted = min(wanted, size)
    most = most or 3 * wanted + 2 * SPARE
    v = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, min(size, wanted + SPARE))))[0]
    av = times(v)
    locked, values = np.empty((size, 0)), np.empty(0)
    scale = stale = 0.0
    for _ in range(OUTER):
        h = v.T @ av
        e, s = np.linalg.eigh((h + h.T) / 2)
        e, s = e[::-1], s[:, ::-1]
        u, au = v @ s, av @ s
        scale = max(scale, np.abs(e).max(initial=0.0), np.abs(values).max(initial=0.0))
        left = _norms(au - u * e)
        done = left <= size * np.finfo(float).eps * scale
        lock = min(int(np.argmin(np.append(done, False))), wanted - len(values))
        locked, values = np.hstack([locked, u[:, :lock]]), np.append(values, e[:lock])
        if len(values) == wanted:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        u, au, e, open_ = u[:, lock:], au[:, lock:], e[lock:], wanted - len(values)
        if u.shape[1] + open_ > most:  # restart from the best
            u, au, e = u[:, : open_ + SPARE], au[:, : open_ + SPARE], e[: open_ + SPARE]
        some = slice(0, min(open_, u.shape[1]))
        r = au[:, some] - u[:, some] * e[some]
        t = minres(times, np.hstack([locked, u[:, some]]), e[some], -r, inner)
        add = _new_directions(t, locked, u)
        if not add.shape[1]:  # the subspace is all there is: products anew, against rounding
            stale += 1
            if stale > 3:
                break
            u = np.linalg.qr(u - locked @ (locked.T @ u))[0]
            v, av = u, times(u)
            continue
        v, av = np.hstack([u, add]), np.hstack([au, times(add)])
    raise RuntimeError(f"residuals of {left[:wanted].max():.3g} against {scale:.3g} are not those of double precision")


class Vectors:
    """Whole vectors of one length as stored blocks of rows of long numbers, with their exact sums."""

    def __init__(self, rows: DataFrame, size: int):
        self.size = size
        each = max(1, BLOCK_ENTRIES // size)

        def pack(batches):
            for b in batches:
                ids, x = b.column(0), b.column(1).flatten().to_numpy(zero_copy_only=False)
                for i in range(0, len(b), each):
                    own = x[i * size : (i + each) * size]
                    yield pa.RecordBatch.from_arrays([pa.array([ids[i : i + each].to_pylist()], pa.list_(pa.int64())), pa.array([own.astype("<i8").tobytes()], pa.binary())], names=["ids", "x"])

        self.blocks = stored(rows.mapInArrow(pack, "ids array<long>, x binary"), "vector-blocks")
        sums = self.total(lambda x: np.append(x.sum(axis=0), len(x)), size + 1, "long")
        self.n, self.sums = int(sums[-1]), sums[:-1]

    def total(self, of: Callable[[np.ndarray], np.ndarray], cells: int, kind: str) -> np.ndarray:
        """The sum over all blocks of an array of ``cells`` numbers."""
        size, dtype = self.size, np.int64 if kind == "long" else np.float64

        def run(batches):
            done = np.zeros(cells, dtype)
            for b in batches:
                for block in b.column(0):
                    done += of(np.frombuffer(block.as_buffer(), "<i8").reshape(-1, size)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(done)], names=["cell", "v"])

        out = np.zeros(cells, dtype)
        for r in self.blocks.select("x").mapInArrow(run, f"cell int, v {kind}").groupBy("cell").agg(F.sum("v").alias("v")).collect():
            out[r["cell"]] = r["v"]
        return out

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        n, sums = self.n, self.sums
        return lambda x: (n * x - sums) / n

    def times(self, columns: np.ndarray) -> np.ndarray:
        """The covariance's product with columns."""
        centred = self.centred()

        def of(x):
            c = centred(x)
            return c.T @ (c @ columns)

        return self.total(of, columns.size, "double").reshape(columns.shape) / self.n


def fit_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """((vec_id, x), length): the vectors without null or non-finite entries, as long numbers floor(64 c) + 1000000. Of vectors of several lengths
    those of the most frequent one stay (ties: the longest), as the others have no covariance with them; length 0 if there are none."""
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & sound)
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    if lengths is None:
        return rows.select("vec_id", F.array().cast("array<long>").alias("x")), 0
    x = F.transform("v", lambda c: F.floor(c * 64).cast("long") + 1_000_000)
    return rows.where(F.size("v") == lengths["length"]).select("vec_id", x.alias("x")), lengths["length"]


def whitened(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): each vector of fit_rows() projected on the ``components`` leading
    eigenvectors of their covariance, over the roots of the eigenvalues.

    Repeated vectors and ids count and are returned as often as they are there; null ids stay null. Components whose eigenvalue is nothing but rounding
    (equal vectors, or fewer vectors than entries) are left out, and so are all if no two vectors differ; no vectors give no rows. Equal eigenvalues
    have any orthonormal vectors of their space. Deviations beyond a long raise. Other columns are left behind.
    """
    rows, size = fit_rows(vectors, id_col, vector_col)
    spec = "vec_id long, deviation long, w array<double>"
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    if not size:
        return empty
    fit = Vectors(rows, size)
    n, sums, centred = fit.n, fit.sums, fit.centred()
    trace = float(fit.total(lambda x: np.array([(centred(x) ** 2).sum()]), 1, "double")[0]) / n
    if not trace > 0:
        return empty
    values, axes = leading(fit.times, size, components)
    real = values > size * np.finfo(float).eps * values[0]
    values, axes = values[real], axes[:, real] / np.sqrt(values[real])
    m = len(values)
    mean = fit.total(lambda x: (centred(x) @ axes).sum(axis=0), m, "double") / n

    def products(x):
        w = centred(x) @ axes - mean
        return w.T @ w

    error = float(np.abs(fit.total(products, m * m, "double").reshape(m, m) / n - np.eye(m)).max())

    def run(batches):
        for b in batches:
            for ids, block in zip(b.column(0), b.column(1), strict=True):
                x = np.frombuffer(block.as_buffer(), "<i8").reshape(-1, size)
                own = n * x - sums
                if (own.astype(float) ** 2).sum(axis=1).max() >= 2.0**63:
                    raise OverflowError("a deviation is beyond a long")
                w = (own / n) @ axes
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, m, dtype=np.int32)), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([ids.values, pa.array((own * own).sum(axis=1)), lists], names=["vec_id", "deviation", "w"])

    shares = F.array([F.lit(float(v)) for v in values / trace])
    made = fit.blocks.mapInArrow(run, spec).select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened"))
    return made.select("vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("i")).alias("explained"), F.lit(error).alias("identity_error"))
