"""Feed-forward network, trained data-parallel in mini-batches.

Layers are Dense(activation) → batch normalisation → dropout, up to three times, then one sigmoid unit; the loss is binary
cross-entropy, the optimiser Adam. Rows are dealt once, by a hash, into the mini-batches of an epoch and written as a table partitioned by
them; a step reads one mini-batch, every task sums gradients over its Arrow batches, sums of tasks are added in a second level of at most the root
of their number, and only those reach the driver, which moves the weights. Weights are bounded by the layers' sizes.

A mini-batch has ``batch_size`` rows, or more where an epoch would have more than ``max_steps`` steps. Normalisation in training uses the statistics of
the Arrow batch at hand; their averages move with momentum and are used for predictions. All draws (weights, dropout) are
functions of the seed, epoch, step, block and batch, and blocks are sorted, so reruns agree up to the order of sums.

Defined results: NULL and NaN features count as 0; rows with a null label take no part in training; without rows the initial weights stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqc.operators.trees import with_scores
from sparkqc.session import write_shared

# Choices of the search space.
ACTIVATIONS = ("relu", "selu", "elu")
INITIALIZERS = ("glorot_uniform", "glorot_normal", "he_uniform", "he_normal")
EPOCHS = 100
PATIENCE = 10
BATCH = 64
MAX_STEPS = 50
BLOCK_ROWS = 50_000
_SELU = (1.0507009873554805, 1.6732632423543772)
_NORM_EPS, _NORM_MOMENTUM = 1e-3, 0.99


@dataclass(frozen=True)
class Layers:
    """Shape of a network: units of each hidden layer, and what all hidden layers share."""

    units: tuple[int, ...] = (32,)
    activation: str = "relu"
    hidden_initializer: str = "glorot_uniform"
    output_initializer: str = "glorot_uniform"
    batch_normalization: bool = False
    dropout: float = 0.0


def _initial(rng: np.random.Generator, fan_in: int, fan_out: int, how: str) -> np.ndarray:
    scale = 2 / (fan_in + fan_out) if how.startswith("glorot") else 2 / fan_in
    if how.endswith("uniform"):
        return rng.uniform(-1, 1, (fan_in, fan_out)) * math.sqrt(3 * scale)
    out = rng.normal(size=(fan_in, fan_out))
    while (far := np.abs(out) > 2).any():  # truncated at two deviations
        out[far] = rng.normal(size=int(far.sum()))
    return out * math.sqrt(scale) / 0.87962566103423978


def initial_weights(layers: Layers, n_features: int, seed: int) -> list[np.ndarray]:
    """Per hidden layer W, b (and scale, shift with normalisation), then W, b of the output."""
    rng = np.random.default_rng(seed)
    out, size = [], n_features
    for units in layers.units:
        out += [_initial(rng, size, units, layers.hidden_initializer), np.zeros(units)]
        if layers.batch_normalization:
            out += [np.ones(units), np.zeros(units)]
        size = units
    return [*out, _initial(rng, size, 1, layers.output_initializer), np.zeros(1)]


def _activate(z: np.ndarray, how: str) -> tuple[np.ndarray, np.ndarray]:
    """Value and slope."""
    if how == "relu":
        return np.maximum(z, 0), (z > 0).astype(float)
    scale, alpha = _SELU if how == "selu" else (1.0, 1.0)
    e = alpha * np.exp(np.minimum(z, 0))
    return scale * np.where(z > 0, z, e - alpha), scale * np.where(z > 0, 1.0, e)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def gradients(layers: Layers, weights: Sequence[np.ndarray], x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> tuple[float, list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
    """(summed loss, its gradient for every weight, batch mean and variance of every normalisation)."""
    i, a, kept, stats = 0, x, [], []
    for _ in layers.units:
        inp, w, b = a, weights[i], weights[i + 1]
        h, slope = _activate(inp @ w + b, layers.activation)
        norm = None
        a = h
        i += 2
        if layers.batch_normalization:
            mean, var = h.mean(0), h.var(0)
            std = np.sqrt(var + _NORM_EPS)
            norm = ((h - mean) / std, std, weights[i])
            a = norm[0] * weights[i] + weights[i + 1]
            stats.append((mean, var))
            i += 2
        mask = (rng.random(a.shape) >= layers.dropout) / (1 - layers.dropout) if layers.dropout > 0 else None
        a = a if mask is None else a * mask
        kept.append((inp, w, slope, norm, mask))
    p = _sigmoid((a @ weights[i] + weights[i + 1])[:, 0])
    q = np.clip(p, 1e-7, 1 - 1e-7)
    loss = float(-(y * np.log(q) + (1 - y) * np.log(1 - q)).sum())
    d = (p - y)[:, None]
    out = [d.sum(0), a.T @ d]
    d = d @ weights[i].T
    for inp, w, slope, norm, mask in reversed(kept):
        if mask is not None:
            d = d * mask
        if norm is not None:
            hat, std, scale = norm
            out += [d.sum(0), (d * hat).sum(0)]
            dh = d * scale
            d = (dh - dh.mean(0) - hat * (dh * hat).mean(0)) / std
        d = d * slope
        out += [d.sum(0), inp.T @ d]
        d = d @ w.T
    return loss, out[::-1], stats


def forward(layers: Layers, weights: Sequence[np.ndarray], norms: Sequence[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> np.ndarray:
    """Probabilities of new rows."""
    i, a = 0, np.nan_to_num(x)
    for n in range(len(layers.units)):
        a = _activate(a @ weights[i] + weights[i + 1], layers.activation)[0]
        i += 2
        if layers.batch_normalization:
            mean, var = norms[n]
            a = (a - mean) / np.sqrt(var + _NORM_EPS) * weights[i] + weights[i + 1]
            i += 2
    return _sigmoid((a @ weights[i] + weights[i + 1])[:, 0])


def _flat(arrays: Sequence[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.ravel(a) for a in arrays]) if arrays else np.zeros(0)


def _shaped(flat: np.ndarray, like: Sequence[np.ndarray]) -> list[np.ndarray]:
    out, at = [], 0
    for a in like:
        out.append(flat[at:at + a.size].reshape(a.shape))
        at += a.size
    return out


def _probability(model: NetworkModel, x: np.ndarray) -> np.ndarray:
    return forward(model.layers, model.weights, model.norms, x)


@dataclass
class NetworkModel:
    features: list
    layers: Layers
    weights: list
    norms: list = field(default_factory=list)
    epochs: int = 0

    def probabilities(self, df: DataFrame, out: str = "probability") -> DataFrame:
        return with_scores(df, self.features, _probability, self, out)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.probabilities(df).withColumn("prediction", (F.col("probability") > 0.5).cast("double"))

    def as_dict(self) -> dict:
        return {"features": list(self.features), "layers": asdict(self.layers), "weights": [w.tolist() for w in self.weights], "norms": [[m.tolist(), v.tolist()] for m, v in self.norms], "epochs": self.epochs}

    @staticmethod
    def from_dict(d: dict) -> NetworkModel:
        layers = Layers(**{**d["layers"], "units": tuple(d["layers"]["units"])})
        return NetworkModel(d["features"], layers, [np.array(w) for w in d["weights"]], [(np.array(m), np.array(v)) for m, v in d["norms"]], d["epochs"])


def _rows(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``(y, x, draw)`` of labelled rows."""
    value = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    return df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), F.array(*map(value, features)).alias("x"), F.xxhash64(*features, label).alias("draw"))


def _summed(parts: DataFrame, many: int) -> np.ndarray:
    """Sum of the vectors (binary, one per task) of ``parts``, in two levels."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for v in batch.column("v").to_pylist():
                x = np.frombuffer(v, "<f8")
                total = x.copy() if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    if many > 1:
        parts = parts.repartition(max(1, math.isqrt(many))).mapInArrow(add, "v binary")
    found = [np.frombuffer(r["v"], "<f8") for r in parts.collect()]  # at most the root of the number of tasks
    return np.sum(found, axis=0) if found else np.zeros(0)


def fit_network(df: DataFrame, features: Sequence[str], label: str, layers: Layers = Layers(), epochs: int = EPOCHS, validation: DataFrame | None = None, patience: int = PATIENCE,
                batch_size: int = BATCH, max_steps: int = MAX_STEPS, learning_rate: float = 1e-3, seed: int = 42) -> NetworkModel:
    """Train for ``epochs``; with ``validation`` rows, until their loss hasn't fallen for ``patience`` epochs."""
    spark, features = df.sparkSession, list(features)
    rows = _rows(df, features, label)
    n = rows.count()
    model = NetworkModel(features, layers, initial_weights(layers, len(features), seed))
    if layers.batch_normalization:
        model.norms = [(np.zeros(u), np.ones(u)) for u in layers.units]
    if not n:
        return model
    steps = max(1, min(max_steps, math.ceil(n / batch_size)))
    blocks = max(1, math.ceil(n / steps / BLOCK_ROWS))
    dealt = rows.withColumn("step", F.pmod(F.xxhash64("draw", F.lit(seed)), F.lit(steps)).cast("int")).withColumn("block", F.pmod(F.xxhash64("draw", F.lit(seed + 1)), F.lit(blocks)).cast("int"))
    path = write_shared(dealt.repartition("step", "block").sortWithinPartitions("step", "block", "draw", "x"), "network-rows", "step")
    held = spark.read.schema(dealt.schema).parquet(path)
    val = _rows(validation, features, label).select("y", "x") if validation is not None else None
    val_n = val.count() if val is not None else 0
    sizes = [(u, u) for u in layers.units] if layers.batch_normalization else []
    m, v, moved = np.zeros(_flat(model.weights).size), np.zeros(_flat(model.weights).size), 0
    best, since = math.inf, 0

    def one_step(epoch: int, step: int) -> np.ndarray:
        shared = spark.sparkContext.broadcast((layers, model.weights, seed))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lay, weights, base = shared.value
            total = None
            for i, batch in enumerate(batches):
                y = batch.column("y").to_numpy()
                if not len(y):
                    continue
                x = batch.column("x").flatten().to_numpy().reshape(len(y), -1)
                rng = np.random.default_rng([base, epoch, step, batch.column("block")[0].as_py(), i])
                loss, grads, stats = gradients(lay, weights, x, y, rng)
                found = np.concatenate([[len(y), loss], _flat(grads), *(len(y) * _flat(s) for s in stats)])
                total = found if total is None else total + found
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

        return _summed(held.where(F.col("step") == step).select("y", "x", "block").mapInArrow(run, "v binary"), blocks)

    def loss_of() -> float:
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            net = shared.value
            for batch in batches:
                y = batch.column("y").to_numpy()
                p = np.clip(_probability(net, batch.column("x").flatten().to_numpy().reshape(len(y), -1)), 1e-7, 1 - 1e-7) if len(y) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([pa.array([float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum())])], names=["s"])

        return (val.mapInArrow(run, "s double").agg(F.sum("s")).first()[0] or 0.0) / val_n

    for epoch in range(epochs):
        for step in range(steps):
            total = one_step(epoch, step)
            if not total.size:
                continue
            count, grad = total[0], total[2:2 + m.size] / total[0]
            moved += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            change = learning_rate * (m / (1 - 0.9 ** moved)) / (np.sqrt(v / (1 - 0.999 ** moved)) + 1e-7)
            model.weights = _shaped(_flat(model.weights) - change, model.weights)
            at = 2 + m.size
            for i, (a, b) in enumerate(sizes):
                mean, var = total[at:at + a] / count, total[at + a:at + a + b] / count
                at += a + b
                model.norms[i] = (_NORM_MOMENTUM * model.norms[i][0] + (1 - _NORM_MOMENTUM) * mean, _NORM_MOMENTUM * model.norms[i][1] + (1 - _NORM_MOMENTUM) * var)
        model.epochs = epoch + 1
        if val_n:
            now = loss_of()
            best, since = (now, 0) if now < best else (best, since + 1)
            if since >= patience:
                break
    return model
