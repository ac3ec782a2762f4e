"""Dense networks: scored in Arrow batches, and trained by steps that are one pass of Spark each.

A step sends the weights to the tasks; each adds up the gradient of the rows it draws, and the parts of all
gradients meet by their place in the weights, so that the driver gets one sum as large as the network however many tasks there
are. Hidden layers are rectified, the output is a probability. Positive rows may weigh more, and training ends when the loss on the
validation rows has not fallen for some checks; the best weights so far are kept.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.session import checkpointed, find_package

#: Numbers of the weights that meet in one place when gradients are added.
SLICE = 1 << 16


@dataclass(frozen=True)
class Network:
    """Layers of weights (inputs, outputs) and biases."""

    weights: tuple[np.ndarray, ...]
    biases: tuple[np.ndarray, ...]

    @staticmethod
    def start(sizes: Sequence[int], seed: int = 0) -> Network:
        """Random weights in proportion to the layers' sizes; ``sizes`` from the inputs to the one output."""
        rng = np.random.default_rng(seed)
        shapes = list(zip(sizes[:-1], sizes[1:], strict=True))
        return Network(tuple(rng.normal(0, np.sqrt(2 / a), (a, b)) for a, b in shapes), tuple(np.zeros(b) for _, b in shapes))

    @property
    def sizes(self) -> list[int]:
        return [self.weights[0].shape[0], *(w.shape[1] for w in self.weights)]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for pair in zip(self.weights, self.biases, strict=True) for x in pair])

    def like(self, flat: np.ndarray) -> Network:
        """The network of the same shape with these numbers."""
        weights, biases, at = [], [], 0
        for w, b in zip(self.weights, self.biases, strict=True):
            weights.append(flat[at : at + w.size].reshape(w.shape))
            biases.append(flat[at + w.size : at + w.size + b.size])
            at += w.size + b.size
        return Network(tuple(weights), tuple(biases))

    def layers(self, x: np.ndarray) -> list[np.ndarray]:
        """What each layer gives; the last before its squashing."""
        out = [x]
        for k, (w, b) in enumerate(zip(self.weights, self.biases, strict=True)):
            x = x @ w + b
            x = np.maximum(x, 0.0) if k + 1 < len(self.weights) else x
            out.append(x)
        return out

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The probability of each row."""
        return 1 / (1 + np.exp(-np.clip(self.layers(x)[-1][:, 0], -500, 500)))

    def gradient(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
        """Weighted sums over the rows of the logarithmic loss and of its gradient."""
        given = self.layers(x)
        z = given[-1][:, 0]
        loss = float((weight * (np.logaddexp(0.0, z) - y * z)).sum())
        back = (weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y))[:, None]
        parts: list[np.ndarray] = []
        for k in reversed(range(len(self.weights))):
            parts += [back.sum(0), (given[k].T @ back).ravel()]
            back = (back @ self.weights[k].T) * (given[k] > 0) if k else back
        return loss, np.concatenate(parts[::-1])

    def to_json(self) -> str:
        return json.dumps({"kind": "dense", "layers": [{"weights": w.tolist(), "bias": b.tolist()} for w, b in zip(self.weights, self.biases, strict=True)]})


def from_spec(spec: dict) -> Network:
    """What :meth:`Network.to_json` wrote."""
    arrays = [(np.asarray(layer["weights"], float), np.asarray(layer["bias"], float)) for layer in spec["layers"]]
    return Network(tuple(w for w, _ in arrays), tuple(b for _, b in arrays))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as rows of a matrix; a null inside is NaN, and a list that is null or shorter is all NaN."""
    column = column.cast(pa.large_list(pa.float64()))
    n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(n.max()) if len(n) else 0
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (n == width).all():
        return flat.reshape(len(n), width)
    out = np.full((len(n), width), np.nan)
    out[n == width] = flat[np.repeat(n == width, n)].reshape(-1, width)
    return out


def scored(network: Network, df: DataFrame, features: str = "features", out: str = "p") -> DataFrame:
    """Add the probability; null where a feature is missing or not finite."""
    find_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(features)) if batch.num_rows else np.zeros((0, network.sizes[0]))
            good = np.isfinite(x).all(1)
            p = network(np.where(good[:, None], x, 0.0)) if batch.num_rows else np.zeros(0)
            yield batch.append_column(out, pa.array(p, pa.float64(), mask=~good))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, `{out}` double")


def summed(network: Network, rows: DataFrame, positive_weight: float, share: float = 1.0, seed: int = 0, gradient: bool = True) -> tuple[float, float, np.ndarray]:
    """(weight, loss, gradient) summed over rows (_x, _y) or a share of them that the seed draws; see SLICE for how they meet."""
    size = network.flat().size

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss, sums = 0.0, 0.0, np.zeros(size)
        for batch in batches:
            x, y = matrix(batch.column("_x")), batch.column("_y").to_numpy(zero_copy_only=False)
            if not len(y):
                continue
            weight = np.where(y == 1, positive_weight, 1.0)
            total += float(weight.sum())
            if gradient:
                more, g = network.gradient(x, y, weight)
                sums += g
            else:
                z = network.layers(x)[-1][:, 0]
                more = float((weight * (np.logaddexp(0.0, z) - y * z)).sum())
            loss += more
        if total:
            parts = [np.array([total, loss]), *(sums[k : k + SLICE] for k in range(0, size if gradient else 0, SLICE))]
            yield pa.record_batch([pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["k", "v"])

    def add(same: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v) for v in same.column("v").to_pylist())
        return pa.table({"k": same.column("k").slice(0, 1), "v": pa.array([total.tobytes()], pa.binary())})

    drawn = rows if share >= 1 else rows.filter(F.pmod(F.xxhash64(F.lit(seed), "_u"), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = {r["k"]: np.frombuffer(r["v"]) for r in drawn.select("_x", "_y").mapInArrow(part, "k int, v binary").groupBy("k").applyInArrow(add, "k int, v binary").collect()}
    if not found:
        return 0.0, 0.0, np.zeros(size)
    return float(found[0][0]), float(found[0][1]), np.concatenate([found[k] for k in range(1, len(found))]) if gradient else np.zeros(size)


@dataclass(frozen=True)
class Training:
    """``share``: of the rows that a step draws; ``check``: steps between looks at the validation rows; ``patience``: looks without a lower loss."""

    hidden: tuple[int, ...] = (32, 32)
    steps: int = 200
    rate: float = 0.01
    penalty: float = 1e-4
    share: float = 1.0
    positive_weight: float = 1.0
    check: int = 10
    patience: int = 3
    seed: int = 0


def train(rows: DataFrame, valid: DataFrame | None = None, params: Training = Training(), features: str = "features", label: str = "label") -> tuple[Network, list[float]]:
    """The network, and the mean loss on the validation rows at each look (on the drawn training rows without any).

    Rows without a label or with features that are not finite take no part. The driver holds the weights and two running means of the
    gradient.
    """
    find_package(rows.sparkSession)
    finite = F.forall(features, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    ready = lambda df: df.select(F.col(features).cast("array<double>").alias(features), F.col(label).cast("double").alias("_y")).filter(finite & F.col("_y").isNotNull()).select(F.col(features).alias("_x"), "_y")
    rows = checkpointed(ready(rows).withColumn("_u", F.monotonically_increasing_id()))
    held = checkpointed(ready(valid)) if valid is not None else None
    first = rows.select(F.size("_x")).first()
    if first is None:
        raise ValueError("no rows to train on")
    network = best = Network.start([first[0], *params.hidden, 1], params.seed)
    mean = square = np.zeros(network.flat().size)
    lowest, waited, losses = np.inf, 0, []
    for step in range(1, params.steps + 1):
        total, loss, g = summed(network, rows, params.positive_weight, params.share, params.seed + step)
        if total:
            at = network.flat()
            g = g / total + params.penalty * at
            mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
            network = network.like(at - params.rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8))
        if step % params.check and step < params.steps:
            continue
        if held is not None:
            total, loss, _ = summed(network, held, params.positive_weight, gradient=False)
        losses.append(loss / max(total, 1e-12))
        if losses[-1] < lowest - 1e-6:
            lowest, waited, best = losses[-1], 0, network
        else:
            waited += 1
            if waited >= params.patience:
                break
    return best, losses
