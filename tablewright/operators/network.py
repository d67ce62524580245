"""A dense regression network trained by data-parallel gradient descent.

Each step sends the weights to the tasks, which run side by side and return the summed gradient of their rows; the driver adds
these up (one row a task, as long as the weights, and TASKS_A_CORE tasks a core at any number of rows) and moves the weights by
Adam. Rows stay where they are stored, each hashed part in files of its own; steps of an epoch read these parts in turn. After every epoch the loss of the validation rows comes from the same kind of job;
training stops when it has not fallen for ``patience`` epochs, and the best weights are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.operators.filters import require
from tablewright.session import scratch_path

FILE_ROWS = 500_000   # training rows in a file, so that files spread over tasks however the source is cut
TASKS_A_CORE = 2      # tasks of a step, each of which returns one gradient
DRAWN_ROWS = 4096     # rows whose dropped values are drawn together
BLOCK_ROWS = 512      # rows whose layers are worked out together: they stay in the processor's cache


class Network(NamedTuple):
    """Weights by layer, and the scaling of features and label; ``losses`` are those of the validation rows by epoch."""

    features: list[str]
    layers: list[tuple[np.ndarray, np.ndarray]]
    centre: np.ndarray
    scale: np.ndarray
    losses: list[float]

    def predict(self, df: DataFrame, into: str) -> DataFrame:
        """``df`` without its rows that miss a feature, with the prediction as ``into``."""
        sent = df.sparkSession.sparkContext.broadcast(self)

        def values(xs: Iterator[pd.Series]) -> Iterator[pd.Series]:
            net = sent.value
            for x in xs:
                x = (np.array(x.tolist(), float).reshape(len(x), -1) - net.centre[:-1]) / net.scale[:-1]
                yield pd.Series(forward(net.layers, x)[-1][:, 0] * net.scale[-1] + net.centre[-1])

        ready = require(df, *self.features)
        return ready.withColumn(into, F.pandas_udf(values, "double")(F.array(*[F.col(f"`{f}`").cast("double") for f in self.features])))


def start(width: int, hidden: tuple[int, ...], seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    draw, sizes = np.random.default_rng(seed), (width, *hidden, 1)
    return [(draw.uniform(-1, 1, (a, b)) * np.sqrt(6 / (a + b)), np.zeros(b)) for a, b in zip(sizes, sizes[1:])]


def forward(layers, x: np.ndarray, masks: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """The values of all layers; hidden ones are rectified and, with ``masks``, partly dropped."""
    out = [x]
    for i, (w, b) in enumerate(layers):
        x = x @ w + b
        if i < len(layers) - 1:
            x = np.maximum(x, 0)
            x = x * masks[i] if masks else x
        out.append(x)
    return out


def gradient(layers, x: np.ndarray, y: np.ndarray, masks: list[np.ndarray] | None = None) -> tuple[float, np.ndarray]:
    """Sum of squared errors over the rows, and its gradient as one vector, layer by layer (weights, then offsets)."""
    values = forward(layers, x, masks)
    error = values[-1][:, 0] - y
    back, parts = 2 * error[:, None], []
    for i in range(len(layers) - 1, -1, -1):
        parts.append(np.concatenate(((values[i].T @ back).ravel(), back.sum(axis=0))))
        if i:
            back = (back @ layers[i][0].T) * (values[i] > 0)
            back = back * masks[i - 1] if masks else back
    return float(error @ error), np.concatenate(parts[::-1])


def _split(vector: np.ndarray, layers) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for w, b in layers:
        out.append((vector[at: at + w.size].reshape(w.shape), vector[at + w.size: at + w.size + b.size]))
        at += w.size + b.size
    return out


def fit(df: DataFrame, features, label: str, is_validation: str, hidden: tuple[int, ...] = (128, 64, 32), epochs: int = 50, steps: int = 4,
        rate: float = 0.01, dropout: float = 0.2, patience: int = 10, seed: int = 42) -> Network:
    """The network of the rows that have features and label; rows flagged ``is_validation`` only decide when to stop.

    Features and label are scaled by their mean and deviation over the training rows. Every row is read once an epoch.
    A dropped value is drawn from a hash-like seed of step and task, so a task that runs again draws alike.
    """
    features = list(features)
    cols = [*features, label]
    ready = require(df, *cols, is_validation)
    picked = [F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(cols)]
    part = F.pmod(F.xxhash64(*picked), F.lit(steps)).cast("int").alias("_part")
    spark, names = df.sparkSession, [f"_{i}" for i in range(len(cols))]
    rows, path = ready.select(*picked, part, F.col(is_validation).alias("_held")), scratch_path(spark, "training")
    rows.write.partitionBy("_held", "_part").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    told = rows.where("not _held").agg(*[F.avg(c) for c in names], *[F.stddev_pop(c) for c in names]).first()
    if told[0] is None:
        raise ValueError("no row has all features and the label: nothing to learn from")
    centre, scale = (np.array(told[i * len(cols): (i + 1) * len(cols)], float) for i in (0, 1))
    scale = np.where(scale > 0, scale, 1.0)
    layers = start(len(features), hidden, seed)
    most = TASKS_A_CORE * spark.sparkContext.defaultParallelism
    schema = "n long, loss double, gradient binary"
    shape = to_arrow_schema(T.StructType.fromDDL(schema))

    def summed(own: DataFrame, layers, step: int | None) -> tuple[int, float, np.ndarray]:
        """Rows, loss and gradient of the rows; without ``step`` nothing is dropped and there is no gradient."""
        sent = spark.sparkContext.broadcast(layers)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            draw = np.random.default_rng([seed, step or 0, TaskContext.get().partitionId()])
            net = sent.value
            n, loss, total = 0, 0.0, np.zeros(sum(w.size + b.size for w, b in net))
            for b in batches:
                for at in range(0, b.num_rows, DRAWN_ROWS):
                    z = (np.column_stack([c.to_numpy() for c in b.slice(at, DRAWN_ROWS).columns]) - centre) / scale
                    n, masks = n + len(z), None
                    if step is not None and dropout:
                        masks = [(draw.random((len(z), w.shape[1])) >= dropout) / (1 - dropout) for w, _ in net[:-1]]
                    for i in range(0, len(z), BLOCK_ROWS):
                        own = slice(i, i + BLOCK_ROWS)
                        x, y = z[own, :-1], z[own, -1]
                        if step is None:
                            loss += float(np.square(forward(net, x)[-1][:, 0] - y).sum())
                            continue
                        more, g = gradient(net, x, y, [m[own] for m in masks] if masks else None)
                        loss, total = loss + more, total + g
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([loss]), pa.array([total.tobytes()])], schema=shape)

        # all tasks in one job: toLocalIterator would start the next one when the last has ended
        found = own.select(*names).coalesce(most).mapInArrow(work, schema).collect()
        n, loss, total = 0, 0.0, 0.0
        for r in found:
            n, loss, total = n + r.n, loss + r.loss, total + np.frombuffer(bytes(r.gradient))
        sent.destroy()
        return n, loss, total

    vector = np.concatenate([np.concatenate((w.ravel(), b)) for w, b in layers])
    first, second, done = np.zeros_like(vector), np.zeros_like(vector), 0
    best, losses, waited = vector, [], 0
    for _ in range(epochs):
        for k in range(steps):
            done += 1
            n, _, g = summed(rows.where(~F.col("_held") & (F.col("_part") == k)), _split(vector, layers), done)
            if not n:
                continue
            g = g / n
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
            vector = vector - rate * (first / (1 - 0.9 ** done)) / (np.sqrt(second / (1 - 0.999 ** done)) + 1e-8)
        n, loss, _ = summed(rows.where("_held"), _split(vector, layers), None)
        losses.append(loss / n if n else float("nan"))
        if not losses[-1] >= min(losses[:-1], default=np.inf):
            best, waited = vector, 0
        else:
            waited += 1
            if waited >= patience:
                break
    return Network(features, _split(best, layers), centre, scale, losses)
