"""Linear classifiers by truncated Newton: squared hinge (support vector machine) and logistic loss.

The objective is ``|w|^2 / 2 + c * sum of weight * loss(y * (w x + b))`` with y of -1 and 1; the intercept is one more
weight, penalised for the squared hinge and free for the logistic loss. Vectors are stored once, in blocks of rows whose
indexes and values are plain bytes that every pass reads without converting them. A gradient, and a product of the Hessian
with a direction, is one pass over them: every task adds up its rows, Spark adds up the tasks by index, and one or two
numbers for each dimension reach the driver. Conjugate gradients, scaled by the diagonal of the Hessian and by the directions
of earlier steps (some hundred, bounded in bytes), solve for the step; it is halved until the objective falls enough. Where doubles no longer tell objectives apart the gradient decides.

The model is bounded by its dimensions (a vocabulary or the length of an embedding), so weights are a broadcast variable.
Rows with other labels than 0 and 1 are left out. Without rows of both classes all weights are 0.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import estimated_bytes, materialize

HINGE, LOGISTIC = "squared_hinge", "logistic"


def margin_losses(kind: str, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss of margins and its first and second derivative."""
    if kind == HINGE:
        short = np.maximum(1 - z, 0)
        return short * short, -2 * short, 2.0 * (short > 0)
    p = np.exp(-np.logaddexp(0, z))  # the probability of the other class
    return np.logaddexp(0, -z), -p, p * (1 - p)


@dataclass(frozen=True)
class NewtonModel:
    """``weights`` has (dim, w) of the weights that are not 0; ``gradient`` is the largest slope that was left."""

    kind: str
    weights: DataFrame
    intercept: float
    size: int
    gradient: float

    def dense(self) -> np.ndarray:
        table = self.weights.toArrow()  # bounded by the dimensions
        w = np.zeros(self.size)
        w[table["dim"].to_numpy()] = table["w"].to_numpy()
        return w

    def score(self, vector: Column) -> Column:
        """Decision value of an array column, computed in the JVM; null for null."""
        w = F.array(*map(F.lit, self.dense().tolist()))
        product = F.zip_with(vector, w, lambda x, y: x.cast("double") * y)
        return F.aggregate(product, F.lit(self.intercept), lambda total, x: total + x)

    def save(self, path: str) -> None:
        self.weights.write.mode("overwrite").parquet(f"{path}/weights")
        head = json.dumps({"kind": self.kind, "intercept": self.intercept, "size": self.size, "gradient": self.gradient})
        self.weights.sparkSession.range(1).select(F.lit(head).alias("value")).write.mode("overwrite").text(f"{path}/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "NewtonModel":
        head = json.loads(spark.read.text(f"{path}/head").first()[0])
        return NewtonModel(head["kind"], spark.read.parquet(f"{path}/weights"), head["intercept"], head["size"], head["gradient"])


# Entries of the vectors in a stored block, about.
BLOCK = 2**17
# Stored bytes of blocks that one task of a pass reads, about.
PASS_BYTES = 8 * 2**20
BLOCK_COLUMNS = ["sizes", "idx", "val", "y", "weight", "norm"]
BLOCK_SCHEMA = ", ".join(f"{c} binary" for c in BLOCK_COLUMNS) + ", n long, n_positive long"
NARROW = {1: np.uint8, 2: np.uint16, 4: np.int32, 8: np.float64}


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them all; other numbers as they are, wide ones as doubles."""
    for kind in (np.uint8, np.uint16):
        small = x.astype(kind) if len(x) == 0 or (x.min() >= 0 and x.max() <= np.iinfo(kind).max) else None
        if small is not None and np.array_equal(small, x):
            return small
    return x if x.dtype == np.int32 else x.astype(np.float64)


def _blocks(batches):
    """Rows of (idx, val, y, weight, norm) as blocks of plain bytes."""
    for batch in batches:
        at, n = 0, batch.num_rows
        ends = np.cumsum(batch.column("idx").value_lengths().to_numpy())
        while at < n:
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, "right")))
            part = batch.slice(at, upto - at)
            idx, val = part.column("idx"), part.column("val")
            columns = [
                idx.value_lengths().to_numpy().astype(np.int32), _narrow(idx.flatten().to_numpy().astype(np.int32)),
                _narrow(val.flatten().to_numpy()), part.column("y").to_numpy(), part.column("weight").to_numpy(), part.column("norm").to_numpy(),
            ]
            counts = [pa.array([len(columns[3])]), pa.array([int((columns[3] > 0).sum())])]
            packed = [pa.array([c.tobytes()], pa.binary()) for c in columns]
            yield pa.RecordBatch.from_arrays(packed + counts, [*BLOCK_COLUMNS, "n", "n_positive"])
            at = upto


def _block_arrays(batch: pa.RecordBatch):
    """For each block: the number of entries of each row, index and value of each entry, and y, weight and norm of each row."""
    for sizes, at, val, *rows in zip(*batch.columns):
        sizes = np.frombuffer(sizes.as_buffer(), np.int32)
        n = max(1, int(sizes.sum()))
        at, val = (np.frombuffer(x.as_buffer(), NARROW[x.as_buffer().size // n or 1]) for x in (at, val))
        yield sizes, at.astype(np.intp), val, *(np.frombuffer(x.as_buffer(), np.float64) for x in rows)


def _row_sums(entries: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out, some = np.zeros(len(sizes)), sizes > 0
    out[some] = np.add.reduceat(entries, (np.cumsum(sizes) - sizes)[some]) if some.any() else 0
    return out


class _Passes:
    """Sums over the stored blocks; the last of ``size + 1`` numbers belongs to the intercept."""

    def __init__(self, blocks: DataFrame, kind: str, c: float, size: int, free: bool, scale: np.ndarray | None = None):
        self.blocks, self.kind, self.c, self.size = blocks, kind, c, size
        self.penalised = np.append(np.ones(size), 0.0 if free else 1.0)
        self.scale = np.append(np.ones(size) if scale is None else scale, 1.0)

    def _sum(self, w: np.ndarray, direction: np.ndarray | None) -> tuple[float, np.ndarray, np.ndarray]:
        """Loss, gradient and diagonal of the Hessian, or without loss and diagonal the product with ``direction``."""
        kind, size, spark = self.kind, self.size, self.blocks.sparkSession
        shared = spark.sparkContext.broadcast((w * self.scale, None if direction is None else direction * self.scale))

        def run(batches):
            w, direction = shared.value
            total, diagonal, loss = np.zeros(size + 1), np.zeros(size + 1), 0.0
            for batch in batches:
                for sizes, at, val, y, weight, norm in _block_arrays(batch):
                    margins = _row_sums(val * w[at], sizes) / norm + w[-1]
                    losses, first, second = margin_losses(kind, y * margins)
                    if direction is None:
                        loss += float(weight @ losses)
                        factor, curve = weight * y * first, weight * second
                        squares = np.square(val, dtype=np.float64)
                        diagonal[:-1] += np.bincount(at, squares * np.repeat(curve / norm**2, sizes), size)
                        diagonal[-1] += curve.sum()
                    else:
                        factor = weight * second * (_row_sums(val * direction[at], sizes) / norm + direction[-1])
                    total[:-1] += np.bincount(at, val * np.repeat(factor / norm, sizes), size)
                    total[-1] += factor.sum()
            some = np.flatnonzero((total != 0) | (diagonal != 0))
            dims, sums, curves = np.append(some, -1), np.append(total[some], loss), np.append(diagonal[some], 0.0)
            yield pa.RecordBatch.from_arrays([pa.array(dims), pa.array(sums), pa.array(curves)], ["dim", "v", "h"])

        # A task has one row for each dimension at most: nothing to combine before these few rows are dealt.
        parts = self.blocks.mapInArrow(run, "dim long, v double, h double").repartition(spark.sparkContext.defaultParallelism, "dim")
        sums = parts.groupBy("dim").agg(F.sum("v").alias("v"), F.sum("h").alias("h")).toArrow()
        shared.destroy()
        dim, v, h = (sums[c].to_numpy() for c in ("dim", "v", "h"))
        out, diagonal = np.zeros(size + 1), np.zeros(size + 1)
        out[dim[dim >= 0]], diagonal[dim[dim >= 0]] = v[dim >= 0], h[dim >= 0]
        return float(v[dim < 0].sum()), out * self.scale, diagonal * self.scale**2

    def objective(self, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Objective, gradient and diagonal of the Hessian."""
        loss, gradient, diagonal = self._sum(w, None)
        own = self.penalised * w
        return float(own @ own) / 2 + self.c * loss, own + self.c * gradient, self.penalised + self.c * diagonal

    def product(self, w: np.ndarray, direction: np.ndarray) -> np.ndarray:
        return self.penalised * direction + self.c * self._sum(w, direction)[1]


# Bytes of directions and their products that the driver keeps from step to step.
KEPT_BYTES = 64 * 2**20


class _Kept:
    """Directions of earlier steps with their products, as a preconditioner for the next ones: the Hessian changes little, so
    what they span needs next to no passes again; the rest is scaled by the diagonal."""

    def __init__(self, size: int):
        self.most = max(2, min(400, KEPT_BYTES // (16 * size)))
        self.directions, self.products = np.zeros((0, size)), np.zeros((0, size))
        self.inner = np.zeros((0, 0))

    def add(self, directions: list[np.ndarray], products: list[np.ndarray]) -> None:
        if not directions:
            return
        self.directions = np.vstack([self.directions, directions])[-self.most :]
        self.products = np.vstack([self.products, products])[-self.most :]
        inner = self.directions @ self.products.T
        values, vectors = np.linalg.eigh((inner + inner.T) / 2)
        good = values > 1e-12 * values.max(initial=0.0)
        self.inner = (vectors[:, good] / values[good]) @ vectors[:, good].T

    def solve(self, left: np.ndarray, scale: np.ndarray) -> np.ndarray:
        """A symmetric positive definite guess of the Hessian's inverse, applied."""
        if not len(self.directions):
            return scale * left
        along = self.inner @ (self.directions @ left)
        rest = scale * (left - along @ self.products)
        return rest + (along - self.inner @ (self.products @ rest)) @ self.directions


def _step(
    passes: _Passes, w: np.ndarray, gradient: np.ndarray, diagonal: np.ndarray, most: int, kept: _Kept, start: float, tol: float
) -> np.ndarray:
    """Conjugate gradients for the Newton step, scaled by the diagonal and by what earlier steps found, as exact as the
    gradient is small beside that of the ``start``, and no more exact than a tenth of ``tol``."""
    scale = 1 / np.where(diagonal > 0, diagonal, 1.0)
    step, left = np.zeros_like(w), -gradient
    direction = kept.solve(left, scale)
    size = float(left @ direction)
    first = float(left @ left)
    goal = max(min(0.25, np.sqrt(first) / start) * first, (tol / 10) ** 2)
    directions, products = [], []
    for _ in range(most):
        if float(left @ left) <= goal or size <= 0:
            break
        turned = passes.product(w, direction)
        bend = float(direction @ turned)
        directions.append(direction / np.sqrt(bend))
        products.append(turned / np.sqrt(bend))
        along = size / bend
        step += along * direction
        left = left - along * turned
        solved = kept.solve(left, scale)
        size, before = float(left @ solved), size
        direction = solved + size / before * direction
    kept.add(directions[-kept.most :], products[-kept.most :])
    return step


def _gathered(blocks: DataFrame) -> DataFrame:
    """The stored blocks in as few files as tasks are worth their while: each task of a pass returns a row for each dimension."""
    tasks = max(blocks.sparkSession.sparkContext.defaultParallelism, -(-estimated_bytes(blocks) // PASS_BYTES))
    return materialize(blocks.coalesce(tasks), "blocks") if blocks.rdd.getNumPartitions() > tasks else blocks


# Objectives whose difference is a smaller part of them than this are equal up to rounding.
ROUNDING = 1e-13


def fit(
    rows: DataFrame, size: int, kind: str = HINGE, c: float = 1.0, tol: float = 1e-6, max_iter: int = 50, max_products: int = 200,
    scale: np.ndarray | None = None,
) -> NewtonModel:
    """Fit to rows of (idx array<int>, val array of numbers, label, weight) until no slope exceeds ``tol``.

    With a ``scale`` of each dimension the vectors are ``val`` times it, through the ``norm`` of the row if there is such a
    column: whole numbers take a byte or two each.
    """
    spark = rows.sparkSession
    signed = rows.where(F.col("label").isin(0, 1)).select(
        "idx", "val", (F.col("label") * 2 - 1).cast("double").alias("y"), F.col("weight").cast("double").alias("weight"),
        (F.coalesce("norm", F.lit(1.0)) if "norm" in rows.columns else F.lit(1.0)).alias("norm"),
    )
    stored = _gathered(materialize(signed.mapInArrow(_blocks, BLOCK_SCHEMA), "vectors"))
    w = np.zeros(size + 1)
    worst = 0.0
    n, positive = stored.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_positive"), F.lit(0))).first()
    if 0 < positive < n:
        passes = _Passes(stored.select(*BLOCK_COLUMNS), kind, c, size, kind == LOGISTIC, scale)
        kept = _Kept(size + 1)
        value, gradient, diagonal = passes.objective(w)
        start = float(np.linalg.norm(gradient))
        for _ in range(max_iter):
            worst = float(np.abs(gradient).max())
            if worst <= tol:
                break
            step = _step(passes, w, gradient, diagonal, max_products, kept, start, tol)
            slope, length = float(step @ gradient), 1.0
            while True:
                new_value, new_gradient, new_diagonal = passes.objective(w + length * step)
                flatter = np.abs(new_gradient).max() < worst
                # Within rounding, halving cannot make the objective fall.
                equal = abs(new_value - value) <= ROUNDING * abs(value)
                if new_value <= value + 1e-4 * length * slope or equal or length < 1e-10:
                    break
                length /= 2
            if not flatter and (equal or new_value >= value):
                break  # as good as doubles can tell
            w, value, gradient, diagonal = w + length * step, new_value, new_gradient, new_diagonal
        worst = float(np.abs(gradient).max())
    some = np.flatnonzero(w[:-1])
    table = pa.table({"dim": pa.array(some, pa.int32()), "w": pa.array(w[:-1][some])})
    return NewtonModel(kind, materialize(spark.createDataFrame(table), "weights"), float(w[-1]), size, worst)


def dense_rows(df: DataFrame, vector: str, label: str = "label", weight: str = "weight") -> DataFrame:
    """The rows that ``fit`` takes, from an array column."""
    idx = F.sequence(F.lit(0), F.size(vector) - 1).cast("array<int>")
    return df.where(F.size(vector) > 0).select(idx.alias("idx"), F.col(vector).cast("array<double>").alias("val"), F.col(label).alias("label"), weight)
