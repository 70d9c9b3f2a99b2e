"""Embedding whitening by shifted CholeskyQR.

Rows stay where they are; only Gram matrices (dimension by dimension) travel, added up by a combining aggregate.

1. Entries become integers on a grid, so the sums, and with them the centred rows (n x - S) / n, are exact up to one
   rounding.
2. The centred rows Y are orthogonalised: the Gram matrix of Y plus a small shift has a Cholesky factor whatever the
   condition of Y; rows times its inverse (a triangular solve in every task) are close to orthogonal, and the next
   passes, without shift, take them to rounding error. Y = Q R with R the product of all factors.
3. Columns that depend on others (a constant entry, one entry twice, fewer rows than entries) show after the first pass
   as directions of no length. They are taken out there; R then has as many rows as Y has independent columns.
4. The singular values s and right vectors of R are those of Y: component k has eigenvalue s_k^2 / n of the covariance.
   A squared matrix is never decomposed, so small components keep their digits.

Defined results: rows whose vector is null, or holds a null, a NaN, an infinity or an entry beyond the grid's 64 bits,
are left out, and so are those of another length than most rows have (of equally common lengths the larger stays).
Rows that repeat an id or a vector count as often as they stand there. There are as many components as independent
directions, at most ``components``; all rows alike, a single row or no row give no component and no row. Other columns
are not read, whatever their names.
"""
from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.llm.common import written

GRID, OFFSET = 1024, 100_000
COMPONENTS = 8
# rows that a task holds as doubles at a time
BLOCK = 4_096
# a direction this much shorter than the longest after the shifted pass has no length
RANK_TOLERANCE = 1e-13
# largest entry of a Gram matrix minus the identity that counts as orthogonal; passes until then
ORTHOGONAL, MAX_PASSES = 1e-13, 6


def usable(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """key, x: the rows that can be used, entries on the grid. One aggregate finds the commonest length."""
    entry = F.col(column)
    bad = F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) * GRID >= 2.0 ** 62))
    good = vectors.where(entry.isNotNull() & (F.size(entry) > 0) & ~F.coalesce(bad, F.lit(True)))
    length = good.groupBy(F.size(entry).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if length is None:
        return good.select(F.col(key), F.lit(None).cast("array<bigint>").alias("x"))
    return good.where(F.size(entry) == length["size"]).select(
        F.col(key), F.transform(entry, lambda c: F.floor(c.cast("double") * GRID) + OFFSET).alias("x"))


def _blocks(batches, name: str = "x"):
    """Rows of integers, at most ``BLOCK`` at a time, with the batch they come from."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            flat = part.column(name).flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(part.num_rows, -1)


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each entry. The halves of 32 bits are added apart, so nothing overflows."""
    def add(batches):
        n, hi, lo = 0, 0, 0
        for part, x in _blocks(batches):
            n, hi, lo = n + part.num_rows, hi + (x >> 32).sum(axis=0), lo + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(hi)), pa.int32()), pa.array([n] * len(hi), pa.int64()),
                                              pa.array(hi), pa.array(lo)], names=["j", "n", "hi", "lo"])

    wide = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("hi", "lo")]
    total = rows.select("x").mapInArrow(add, "j int, n long, hi long, lo long").groupBy("j").agg(
        F.sum("n").alias("n"), *wide).orderBy("j").collect()
    return (total[0]["n"], [int(r["hi"]) * 2 ** 32 + int(r["lo"]) for r in total]) if total else (0, [])


def _scaled(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n x - S, exact: in 64 bits where all of it fits, else in Python's integers."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, total))
    if reach < 2 ** 62:
        return n * x - np.array(total, np.int64)
    return n * x.astype(object) - np.array(total, object)


def _squares(scaled: np.ndarray) -> list[int]:
    """Exact sum of squares of each row."""
    if scaled.dtype != object:
        largest = int(np.abs(scaled).max(initial=0))
        if largest * largest * scaled.shape[1] < 2 ** 63:
            return (scaled * scaled).sum(axis=1).tolist()
    return [sum(int(v) * int(v) for v in row) for row in scaled]


@dataclass(frozen=True)
class Factors:
    """What a task needs to turn a row x into its row of Q: count, sums and the solves so far."""

    n: int
    total: list[int]
    solves: list[np.ndarray]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _scaled(x, self.n, self.total).astype(np.float64) / self.n

    def rows(self, x: np.ndarray) -> np.ndarray:
        q = self.centred(x)
        for step in self.solves:
            # upper triangular factors are solved, a basis (taller than wide) is multiplied
            q = np.linalg.solve(step.T, q.T).T if step.shape[0] == step.shape[1] else q @ step
        return q


def gram(rows: DataFrame, factors: Factors) -> np.ndarray:
    """Gram matrix of the orthogonalised rows so far: every task adds up its rows, the aggregate adds up the tasks."""
    def add(batches):
        total = None
        for _, x in _blocks(batches):
            q = factors.rows(x)
            total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                             names=["i", "j", "v"])

    parts = rows.select("x").mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    cells = parts.toPandas()
    size = int(cells["i"].max()) + 1
    out = np.zeros((size, size))
    out[cells["i"], cells["j"]] = cells["v"]
    return out + np.triu(out, 1).T


def decompose(rows: DataFrame, n: int, total: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and components (rows) of the covariance, from the R of a shifted CholeskyQR."""
    d, unit = len(total), np.finfo(float).eps / 2
    factors = Factors(n, total, [])
    first = gram(rows, factors)
    if not np.trace(first) > 0:
        return np.zeros(0), np.zeros((0, d))
    shift = 11 * (float(d) * n + d * (d + 1)) * unit * np.linalg.norm(first, 2)
    # beyond some 1e11 rows the bound of the proof is of no use; a thousandth of the mean variance always is
    shift = min(shift, 1e-3 * np.trace(first) / d)
    r = np.linalg.cholesky(first + shift * np.eye(d)).T
    factors = Factors(n, total, [r])
    for _ in range(MAX_PASSES):
        now = gram(rows, factors)
        if np.abs(now - np.eye(len(now))).max() <= ORTHOGONAL:
            break
        lengths, basis = np.linalg.eigh(now)
        there = lengths > RANK_TOLERANCE * lengths[-1]
        solves = factors.solves
        if not there.all():
            basis = basis[:, there]
            r, now, solves = basis.T @ r, basis.T @ now @ basis, [*solves, basis]
        # a Gram matrix that is still close to singular takes a shift again
        nudge = 0.0 if lengths[there][0] > 1e-8 * lengths[-1] else 1e-12 * lengths[-1]
        step = np.linalg.cholesky(now + nudge * np.eye(len(now))).T
        r, factors = step @ r, Factors(n, total, [*solves, step])
    _, singular, right = np.linalg.svd(r, full_matrices=False)
    return singular ** 2 / n, right


def _project(rows: DataFrame, key: str, n: int, total: list[int], eigenvalues: np.ndarray,
             components: np.ndarray) -> DataFrame:
    factors = Factors(n, total, [])
    turn = components.T / np.sqrt(eigenvalues)

    def run(batches):
        for part, x in _blocks(batches):
            scaled = _scaled(x, n, total)
            z = scaled.astype(np.float64) / n @ turn
            yield pa.RecordBatch.from_arrays([
                part.column(key), pa.array([Decimal(v) for v in _squares(scaled)], pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, z.shape[1]), pa.int32()), pa.array(z.ravel()))],
                names=[key, "deviation", "whitened"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, k: int) -> float:
    """Largest entry of the covariance of the whitened rows minus the identity, centred before multiplying."""
    means = rows.agg(*[F.avg(F.col("whitened")[i]).alias(f"m{i}") for i in range(k)]).first()
    centred: list[Column] = [F.col("whitened")[i] - F.lit(means[i]) for i in range(k)]
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    cov = rows.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in cells]).first()
    return max(abs(cov[c] - (i == j)) for c, (i, j) in enumerate(cells))


def whiten(spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id",
           column: str = "embedding") -> DataFrame:
    """key, component, n, deviation (decimal), whitened, eigenvalue, explained, identity_error: one row for each usable
    row and component."""
    rows = usable(vectors, key, column)
    n, total = sums(rows)
    eigenvalues, right = decompose(rows, n, total) if n > 1 else (np.zeros(0), None)
    k = min(components, len(eigenvalues))
    if not k:
        return rows.select(key, F.lit(0).alias("component"), F.lit(0).cast("bigint").alias("n"),
                           F.lit(0).cast("decimal(38,0)").alias("deviation"),
                           *[F.lit(0.0).alias(c) for c in ("whitened", "eigenvalue", "explained", "identity_error")]).where("false")
    z = written(spark, _project(rows, key, n, total, eigenvalues[:k], right[:k]), "whitened")
    share = (eigenvalues / eigenvalues.sum())[:k]
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("component"))
    return z.select(key, "deviation", F.posexplode("whitened").alias("at", "whitened")).withColumn(
        "component", F.col("at") + 1).select(
        key, "component", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        pick(eigenvalues[:k]).alias("eigenvalue"), pick(share).alias("explained"),
        F.lit(identity_error(z, k)).alias("identity_error"))
