"""Whitening of vectors by principal components: shifted Cholesky QR in distributed Gram passes, then an SVD of the triangular factor."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import rows_of, table

#: Components that a row gets, steps of a whole in an entry, what is added to it, and Gram passes at most.
COMPONENTS, STEPS, BASE, PASSES = 32, 64, 1_000_000, 12
_EPS = np.finfo(np.float64).eps


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that stay."""
    own = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].cast("array<double>").alias("embedding"))
    return own.where("embedding is not null").where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray]]:
    """Ids and whole numbers of a batch's vectors, those of one length together."""
    for batch in batches:
        for part in rows_of(batch):
            lists = part.column("embedding")
            flat, size = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
            ids, ends = np.array(part.column("vec_id").to_pylist(), dtype=object), np.cumsum(size)
            for dim in np.unique(size).tolist():
                at = np.flatnonzero(size == dim)
                c = np.floor(STEPS * flat[(ends[at] - dim)[:, None] + np.arange(dim)])
                if c.size and np.abs(c).max() >= 2.0**62:
                    raise OverflowError("an entry is beyond a long")
                yield ids[at].tolist(), c.astype(np.int64) + BASE


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: longs where they hold it, else Python's integers."""
    fits = x.size == 0 or n * int(np.abs(x).max()) + max(map(abs, sums)) < 2**63
    return n * x - np.array(sums, np.int64) if fits else n * x.astype(object) - np.array(sums, object)


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """rows times the inverse of a triangular factor, by substitution."""
    out = np.empty_like(rows)
    for j in range(len(upper)):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def added(own: DataFrame, of: Callable[[np.ndarray], dict[str, np.ndarray] | None]) -> dict[int, dict[str, np.ndarray]]:
    """By length of the vectors: of() of every matrix, added up over all of them. A task sends one row for each entry of its
    sums; Spark adds these by entry, so the driver gets as many numbers as one of() has, whatever the rows."""

    def run(batches):
        held: dict[tuple[int, str], np.ndarray] = {}
        for _, x in matrices(batches):
            for what, value in (of(x) or {}).items():
                key = (x.shape[1], what)
                held[key] = held[key] + value if key in held else value
        for (dim, what), value in held.items():
            flat = value.ravel()
            for at in range(0, len(flat), 1 << 16):
                some = flat[at : at + (1 << 16)]
                yield pa.RecordBatch.from_pydict({"dim": [dim] * len(some), "what": [what] * len(some), "at": np.arange(at, at + len(some)), "value": some}, schema=pa.schema([("dim", pa.int32()), ("what", pa.string()), ("at", pa.int64()), ("value", pa.float64())]))

    total = own.mapInArrow(run, "dim int, what string, at long, value double").groupBy("dim", "what", "at").agg(F.sum("value").alias("value"))
    out: dict[int, dict[str, dict]] = {}
    for r in total.toLocalIterator():
        out.setdefault(r.dim, {}).setdefault(r.what, {})[r.at] = r.value
    return {dim: {what: np.array([v[k] for k in sorted(v)]) for what, v in parts.items()} for dim, parts in out.items()}


def totals(own: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """By length: number of vectors and exact sums of their whole numbers."""

    def run(batches):
        held: dict[int, list] = {}
        for ids, x in matrices(batches):
            n, s = held.get(x.shape[1], (0, np.zeros(x.shape[1], object)))
            held[x.shape[1]] = (n + len(ids), s + x.astype(object).sum(axis=0) if x.size else s)
        for dim, (n, s) in held.items():
            value = [Decimal(n), *(Decimal(int(v)) for v in s)]
            yield pa.RecordBatch.from_pydict({"dim": [dim] * len(value), "at": range(len(value)), "value": value}, schema=pa.schema([("dim", pa.int32()), ("at", pa.int64()), ("value", pa.decimal128(28, 0))]))

    out: dict[int, dict[int, int]] = {}
    for r in own.mapInArrow(run, "dim int, at long, value decimal(28,0)").groupBy("dim", "at").agg(F.sum("value").alias("value")).toLocalIterator():
        out.setdefault(r.dim, {})[r.at] = int(r.value)
    return {dim: (v[0], [v[k] for k in range(1, dim + 1)]) for dim, v in out.items()}


def factors(own: DataFrame, size: dict[int, tuple[int, list[int]]]) -> dict[int, tuple[list[np.ndarray], np.ndarray]]:
    """By length: the triangular factors in turn, and the Gram matrix of what they leave, which is near a projection.

    A pass solves every centred row through the factors so far and adds up the Gram matrix of the results; its Cholesky factor
    is the next one. While that matrix is far from the identity a shift of its rounding error keeps the factor whole, however
    dependent the dimensions are."""
    found: dict[int, list[np.ndarray]] = {dim: [] for dim in size if dim}
    grams: dict[int, np.ndarray] = {}
    for _ in range(PASSES):
        todo = {dim: list(rs) for dim, rs in found.items() if dim not in grams}
        if not todo:
            break

        def gram(x, todo=todo):
            if x.shape[1] not in todo:
                return None
            n, sums = size[x.shape[1]]
            q = centred(x, n, sums).astype(np.float64) / n
            for r in todo[x.shape[1]]:
                q = solved(q, r)
            return {"gram": q.T @ q}

        for dim, part in added(own, gram).items():
            w = part["gram"].reshape(dim, dim)
            w = (w + w.T) / 2
            top = float(np.linalg.eigvalsh(w)[-1])
            if top <= 0 or found[dim] and np.abs(w @ w - w).max() <= 1e-12 * dim:
                grams[dim] = w
                continue
            # The error of the sums within a batch and of the factor itself; more where that turns out too little.
            shift = 0.0 if found[dim] and np.abs(w - np.eye(dim)).max() < 0.5 else 11 * (dim * dim + dim * min(size[dim][0], 1 << 15)) * _EPS * top
            while True:
                try:
                    found[dim].append(np.linalg.cholesky(w + shift * np.eye(dim)).T)
                    break
                except np.linalg.LinAlgError:
                    shift = max(100 * shift, dim * _EPS * top)
            grams_last = w
            if len(found[dim]) == PASSES:  # the last factor isn't used: the matrix before it says what is left
                found[dim].pop()
                grams[dim] = grams_last
    return {dim: (found[dim], grams[dim]) for dim in grams}


def components(rs: list[np.ndarray], left: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of the covariance and unit eigenvectors as columns, those of variance zero left out. The centred rows
    are Q R with Q's Gram matrix `left`; its root times R has an SVD with the singular values of the rows themselves."""
    r = np.eye(len(left))
    for x in rs:
        r = x @ r
    e, z = np.linalg.eigh(left)
    root = np.sqrt(np.maximum(e, 0))[:, None] * z.T
    _, s, vt = np.linalg.svd(root @ r)
    keep = s > 8 * len(s) * _EPS * s[0] if len(s) and s[0] > 0 else np.zeros(len(s), bool)
    s, v = s[keep], vt[keep].T
    v = v / np.sqrt((v * v).sum(axis=0))
    v *= np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])  # one sign for all runs
    return s * s / n, v


def whitened(vectors: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each usable vector and each of its first `most`
    components.

    A vector that is null, or holds a null, NaN or infinite entry, goes. Entries become whole numbers x = floor(64 c) + 1000000, so
    n, the sums and deviation are exact. Vectors of different lengths are different spaces, each with its own fit, n and components. A
    component of variance zero has no whitened value, so a space has as many components as the covariance has rank: none where all
    vectors are equal or empty. Repeated rows count and return as rows of their own, null ids too; no rows, no result. An entry or a
    deviation beyond a long is an error, never a wrapped number. The driver holds a few matrices of a vector's length squared,
    whatever the rows; every pass rereads the table, so a lost executor costs its share of one scan."""
    own = usable(vectors, id_col, vec_col)
    size = totals(own)
    fit = {}
    for dim, (rs, left) in factors(own, size).items():
        n, sums = size[dim]
        e, v = components(rs, left, n)
        if len(e):
            # trace(V) from all eigenvalues; what was left out is below rounding.
            fit[dim] = (n, sums, e[:most], v[:, :most], e[:most] / e.sum())

    def project(x):
        n, sums, e, v, _ = fit[x.shape[1]]
        z = centred(x, n, sums)
        return z, (z.astype(np.float64) / n) @ v / np.sqrt(e)

    def second(x):
        if x.shape[1] not in fit:
            return None
        w = project(x)[1]
        return {"sum": w.sum(axis=0), "gram": w.T @ w}

    error = {}
    for dim, part in added(own, second).items() if fit else ():
        n, k = fit[dim][0], len(fit[dim][2])
        mean = part["sum"] / n
        error[dim] = float(np.abs(part["gram"].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())

    kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def run(batches):
        for ids, x in matrices(batches):
            if x.shape[1] not in fit:
                continue
            (n, _, e, _, share), (z, w) = fit[x.shape[1]], project(x)
            if z.dtype == object or float(np.abs(z).max()) ** 2 * z.shape[1] >= 2.0**62:
                z = z.astype(object)
            deviation = (z * z).sum(axis=1)
            if z.dtype == object and max(deviation) >= 2**63:
                raise OverflowError("a deviation is beyond a long")
            k, m = len(e), len(ids)
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array(ids, pa.int64()).take(np.repeat(np.arange(m), k)), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), "n": pa.array(np.full(m * k, n, np.int64)),
                "deviation": pa.array(np.repeat(deviation.astype(np.int64), k)), "whitened": pa.array(w.ravel()), "explained": pa.array(np.tile(share, m)), "identity_error": pa.array(np.full(m * k, error[x.shape[1]])),
            })

    return own.mapInArrow(run, kind)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every usable vector of embeddings; see whitened() for odd rows."""
    return whitened(table(spark, sf_dir, "embeddings"))
