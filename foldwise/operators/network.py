"""Dense networks as data: weights in a table, scored in Arrow batches on the executors.

A linear softmax model is the one-layer case. Batch normalisation and standardisation are affine, so
they are folded into the neighbouring dense layer instead of being layers of their own.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need not have this package installed: its functions travel with the job. Broadcast
# values are pickled by reference, so they hold plain tuples and arrays only.
cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])

ACTIVATIONS = ("identity", "relu", "sigmoid", "softmax")

# Networks are sent to every executor; beyond this they would need another plan.
MAX_BROADCAST_BYTES = 512 * 1024 * 1024

NETWORK_SCHEMA = T.StructType(
    [
        T.StructField("n_fold", T.LongType(), False),
        T.StructField("layer", T.LongType(), False),
        T.StructField("activation", T.StringType(), False),
        T.StructField("weights", T.ArrayType(T.ArrayType(T.DoubleType(), False), False), False),
        T.StructField("bias", T.ArrayType(T.DoubleType(), False), False),
    ]
)


@dataclass(frozen=True)
class Dense:
    weights: np.ndarray  # inputs x outputs
    bias: np.ndarray
    activation: str

    def __post_init__(self):
        if self.activation not in ACTIVATIONS:
            raise ValueError(f"activation {self.activation!r} is not one of {ACTIVATIONS}")
        if self.weights.ndim != 2 or self.bias.shape != (self.weights.shape[1],):
            raise ValueError("weights must be inputs x outputs and the bias must match the outputs")


def forward(layers, x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` through plain ``(weights, bias, activation)`` layers."""
    for weights, bias, activation in layers:
        x = x @ weights + bias
        if activation == "relu":
            x = np.maximum(x, 0.0)
        elif activation == "sigmoid":
            x = 0.5 * (1.0 + np.tanh(0.5 * x))
        elif activation == "softmax":
            e = np.exp(x - x.max(axis=1, keepdims=True))
            x = e / e.sum(axis=1, keepdims=True)
    return x


@dataclass(frozen=True)
class Network:
    layers: tuple[Dense, ...]

    @property
    def n_inputs(self) -> int:
        return self.layers[0].weights.shape[0]

    @property
    def n_outputs(self) -> int:
        return self.layers[-1].weights.shape[1]

    @property
    def nbytes(self) -> int:
        return sum(l.weights.nbytes + l.bias.nbytes for l in self.layers)

    @property
    def plain(self) -> tuple:
        """Layers without classes of this package, fit to be broadcast."""
        return tuple((l.weights, l.bias, l.activation) for l in self.layers)

    def forward(self, x: np.ndarray) -> np.ndarray:
        return forward(self.plain, x)

    def on_raw_inputs(self, mean, std) -> "Network":
        """The same network for inputs that are not yet standardised.

        ((x - m) / s) W + b  =  x (W / s) + (b - (m / s) W)
        """
        mean, std = np.asarray(mean, float), np.asarray(std, float)
        first = self.layers[0]
        scaled = first.weights / std[:, None]
        return Network((Dense(scaled, first.bias - mean @ scaled, first.activation), *self.layers[1:]))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow list column as a rows x width matrix, without a copy per row."""
    flat = column.flatten()
    if column.null_count or flat.null_count:
        raise ValueError("features must not be NULL")
    if len(flat) != len(column) * width:
        raise ValueError(f"expected {width} features per row")
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), width)


def _lists(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    offsets = pa.array(np.arange(0, rows * width + 1, width), pa.int32()) if width else pa.array([0] * (rows + 1), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel(), pa.float64()))


def matrix_function(spark: SparkSession, compute, shared, width: int):
    """A column function ``array<double> -> array<double>`` that sees whole Arrow batches.

    ``shared`` is broadcast once; ``compute(shared, matrix)`` returns one output row per input row.
    """
    held = spark.sparkContext.broadcast(shared)

    @F.arrow_udf("array<double>")
    def apply(values: pa.Array) -> pa.Array:
        return _lists(compute(held.value, _matrix(values, width)))

    return apply


def check_size(networks: dict[int, Network]) -> None:
    size = sum(n.nbytes for n in networks.values())
    if size > MAX_BROADCAST_BYTES:
        raise ValueError(f"networks of {size} bytes are too large to send to every executor")


def fold_output(spark: SparkSession, networks: dict[int, Network]):
    """``f(features, n_fold)``: each row through the network of its own fold, all folds in one pass."""
    check_size(networks)
    held = spark.sparkContext.broadcast({k: n.plain for k, n in networks.items()})
    width = next(iter(networks.values())).n_inputs
    outputs = next(iter(networks.values())).n_outputs

    @F.arrow_udf("array<double>")
    def score(values: pa.Array, folds: pa.Array) -> pa.Array:
        x = _matrix(values, width)
        fold = folds.to_numpy(zero_copy_only=False)
        out = np.empty((len(x), outputs))
        for k in np.unique(fold):
            rows = fold == k
            out[rows] = forward(held.value[int(k)], x[rows])
        return _lists(out)

    return score


def mean_output(spark: SparkSession, networks: dict[int, Network]):
    """``f(features)``: mean over the networks of all folds; features cross to Python once."""
    check_size(networks)
    width = next(iter(networks.values())).n_inputs

    def mean(held, x):
        return sum(forward(layers, x) for layers in held) / len(held)

    return matrix_function(spark, mean, [networks[k].plain for k in sorted(networks)], width)


def network_table(spark: SparkSession, networks: dict[int, Network]) -> DataFrame:
    """Networks as rows (fold, layer, activation, weights, bias): the form they are stored in."""
    rows = [
        (int(k), i, layer.activation, layer.weights.tolist(), layer.bias.tolist())
        for k, network in sorted(networks.items())
        for i, layer in enumerate(network.layers)
    ]
    return spark.createDataFrame(rows, NETWORK_SCHEMA)


def read_networks(table: DataFrame) -> dict[int, Network]:
    """Networks of a table on the driver, after a check that they are small enough to be sent around."""
    cells = table.select(F.sum(F.size("bias").cast("bigint") * (F.size("weights") + 1)).alias("n")).first()["n"] or 0
    if cells * 8 > MAX_BROADCAST_BYTES:
        raise ValueError(f"networks of {cells * 8} bytes are too large to send to every executor")
    layers: dict[int, list] = {}
    for r in table.orderBy("n_fold", "layer").collect():
        layers.setdefault(int(r["n_fold"]), []).append(
            Dense(np.array(r["weights"], float), np.array(r["bias"], float), r["activation"])
        )
    return {k: Network(tuple(v)) for k, v in layers.items()}


def prob_structs(probs: Column, n_classes: int) -> Column:
    """Array of probabilities -> array of (label, prob), labels from 1."""
    pairs = [F.struct(F.lit(k).cast("bigint").alias("label"), probs[k - 1].alias("prob")) for k in range(1, n_classes + 1)]
    return F.array(*pairs)
