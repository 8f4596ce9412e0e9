"""Whitening of embeddings by shifted CholeskyQR (Fukaya et al. 2020).

The distinct vectors, centred, are a tall matrix ``A`` that stays where it is. A pass adds up its small Gram matrix in
each task and sums those; a Cholesky factor of it, shifted so that it exists, gives a triangular ``R`` such that
``A R^-1`` is nearer to orthonormal columns. Further passes solve the triangles again on the fly and compose the factors,
until the Gram matrix is the identity (or a projection, where dimensions depend on each other). Then ``A`` has the
singular values and right vectors of the composed ``R``, from which the components follow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize

#: Entries are fixed-point numbers: so many steps a unit, and what is added.
STEPS, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Gram matrices are first summed in so many tasks.
SUMS = 16
PASSES = 12
_UNIT = np.finfo(float).eps / 2
_SUM = "slot int, n long, total binary"


def fixed_point(embedding: Column) -> Column:
    """``floor(64 * entry) + 1000000`` of each entry, in double precision."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * STEPS).cast("long") + F.lit(OFFSET).cast("long"))


def valid_rows(vectors: DataFrame, vec: str, embedding: str) -> DataFrame:
    """``(vec_id, x)`` of the vectors that are not empty and whose entries are all finite numbers."""
    wrong = F.exists(F.col(embedding), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = (F.size(embedding) > 0) & ~wrong
    # Checked before the entries become numbers, in one expression, as filters may be reordered.
    x = F.when(usable, fixed_point(F.col(embedding)))
    return vectors.select(F.col(vec).alias("vec_id"), x.alias("x")).filter(F.col("x").isNotNull())


def _stacked(frame: pd.DataFrame) -> np.ndarray:
    return np.stack(frame["x"].to_numpy()).astype(np.int64)


def _summed(fit: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: type) -> tuple[int, np.ndarray]:
    """Number of rows of ``fit``, and the sum of ``part`` over batches of its vectors.

    ``part`` gives an array of a fixed shape (a vector or a square matrix of the dimensions), which is all that
    leaves a task; two levels of sums keep what the driver gets to :data:`SUMS` of them.
    """
    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, None
        for frame in frames:
            if len(frame):
                piece = part(_stacked(frame))
                n, total = n + len(frame), piece if total is None else total + piece
        if total is not None:
            yield pd.DataFrame({"slot": [TaskContext.get().partitionId() % SUMS], "n": [n], "total": [total.tobytes()]})

    def joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, list] = {}
        for frame in frames:
            for slot, n, total in zip(frame["slot"], frame["n"], frame["total"], strict=True):
                held = sums.setdefault(slot, [0, 0])
                held[0] += n
                held[1] = held[1] + np.frombuffer(total, kind)
        yield pd.DataFrame([(slot, n, total.tobytes()) for slot, (n, total) in sums.items()], columns=["slot", "n", "total"])

    rows = fit.mapInPandas(local, _SUM).repartition(SUMS, "slot").mapInPandas(joined, _SUM).collect()
    totals = [np.frombuffer(r["total"], kind) for r in sorted(rows, key=lambda r: r["slot"])]
    return sum(r["n"] for r in rows), sum(totals) if totals else np.zeros(0, kind)


@dataclass(frozen=True)
class Whitening:
    """Sums of the fit list, its components as columns (largest eigenvalue first), and how white the result is."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact."""
        return x * self.n - self.sums

    def project(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) / self.n) @ (self.components / np.sqrt(self.eigenvalues))


def _triangle(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper ``R`` with ``R'R = gram + shift``; the shift grows until rounding does no harm."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(shift * 10, _UNIT)


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct vector of ``rows`` once, stored; copies are combined in each task before the shuffle."""
    return materialize(rows.select("x").distinct(), "vectors")


def fit(distinct: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """Components of the stored ``distinct`` vectors; None where there is no vector.

    A task keeps one batch and one matrix of the dimensions; the driver sees :data:`SUMS` such matrices a pass.
    Components without variance are left out.
    """
    n, sums = _summed(distinct, lambda x: x.sum(axis=0), np.int64)
    if not n:
        return None
    d = len(sums)
    if int(np.abs(sums).max()) * 4 > np.iinfo(np.int64).max:
        raise OverflowError("the centred vectors do not fit 64 bits")
    state = Whitening(n, sums, np.eye(d), np.ones(d), 0.0, 0.0)

    def gram(inverse: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            q = (state.centred(x) / n) @ inverse
            return (q.T @ q).ravel()
        return _summed(distinct, part, float)[1].reshape(d, d)

    total = gram(np.eye(d))
    first, r, g = total, np.eye(d), total
    for step in range(PASSES):
        if not np.trace(first) > 0:
            break
        if not step:  # the published shift, by the Frobenius norm
            shift = 11 * _UNIT * (n * d + d * (d + 1)) * np.trace(g)
        else:  # nearly orthonormal columns need none
            shift = 0.0 if np.abs(g - np.eye(d)).max() < 0.5 else _UNIT * d
        r_new = _triangle(g, shift)
        r = r_new @ r
        g = gram(np.linalg.inv(r))
        values = np.linalg.eigvalsh(g)
        if np.minimum(np.abs(values - 1), np.abs(values)).max() < 1e-12:
            break
    # A'A = R' G R; G is the identity up to rounding, or a projection, so its root completes R.
    values, axes = np.linalg.eigh(g)
    root = np.sqrt(np.maximum(values, 0))[:, None] * axes.T
    _, singular, right = np.linalg.svd(root @ r)
    kept = singular > singular[0] * 64 * d * _UNIT if singular[0] > 0 else np.zeros(d, bool)
    components = right[kept][:most].T
    # Either sign would do; the entry of the largest size is positive.
    if components.shape[1]:
        components = components * np.sign(components[np.abs(components).argmax(axis=0), np.arange(components.shape[1])])
    eigenvalues = singular[kept][:most] ** 2 / n
    found = Whitening(n, sums, components, eigenvalues, float(np.trace(first)) / n, 0.0)
    k = len(eigenvalues)
    if not k:
        return found

    def white(x: np.ndarray) -> np.ndarray:
        w = found.project(x)
        return (w.T @ w).ravel()

    covariance = _summed(distinct, white, float)[1].reshape(k, k) / n
    return Whitening(n, sums, components, eigenvalues, found.trace, float(np.abs(covariance - np.eye(k)).max()))


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """``(vec_id, deviation, whitened)``: the exact squared distance of ``n x`` from the sums, and the projections.

    A deviation beyond 63 bits is an error.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            x = _stacked(frame)
            far = model.centred(x)
            if (np.square(far.astype(float)).sum(axis=1) > 2.0 ** 62.9).any():
                raise OverflowError("a deviation does not fit 64 bits")
            yield pd.DataFrame({"vec_id": frame["vec_id"], "deviation": (far * far).sum(axis=1), "whitened": list(model.project(x))})

    kind = dict(rows.dtypes)["vec_id"]
    return rows.mapInPandas(run, f"vec_id {kind}, deviation long, whitened array<double>")


def components(
    vectors: DataFrame, most: int = COMPONENTS, vec: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each vector and component.

    Vectors that are null, empty, or hold null, NaN or infinite entries are left out, and so are vectors of another
    length than the most frequent one (of equals, the shortest). A null or repeated id stays as often as it comes.
    Components without variance are none, so a table with one distinct vector, like an empty one, gives no rows.
    """
    rows = valid_rows(vectors, vec, embedding)
    length = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    schema = f"vec_id {dict(rows.dtypes)['vec_id']}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if length is not None:
        rows = rows.filter(F.size("x") == length["d"])
        model = fit(fit_list(rows), most)
        if model is not None and len(model.eigenvalues):
            shares = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
            return whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
                "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
    return vectors.sparkSession.createDataFrame([], schema)
