"""Smooth minimisation over blocks of rows.

``minimise`` runs L-BFGS: each evaluation is one Spark job in which every task
adds up value and gradient over its blocks (numpy, the rows stay where they
are) and sends one row per parameter, summed by parameter.  The driver holds the
parameters and a few past steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.operators.blocks import read_blocks

#: Past steps that shape the next one.
MEMORY = 10

# value and gradient of some rows: features (one row per feature), labels (one row per label), parameters
BlockLoss = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[float, np.ndarray]]


def summed_loss(blocks: DataFrame, n_labels: int, n_features: int, loss: BlockLoss, params: np.ndarray) -> tuple[float, np.ndarray]:
    """Value and gradient over all rows of the blocks (of
    :func:`tabkit.operators.blocks.pack_blocks`, with values)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(params) + 1)
        for batch in batches:
            for block in read_blocks(batch, n_labels, n_features, 0):
                value, gradient = loss(block.x, block.y, params)
                total[0] += value
                total[1:] += gradient
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["i", "v"])

    out = np.zeros(len(params) + 1)
    for r in blocks.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out[0], out[1:]


def minimise(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, max_iter: int = 100,
             tolerance: float = 1e-6) -> tuple[np.ndarray, float]:
    """A minimum of ``evaluate`` (value and gradient) from ``start``: after
    ``max_iter`` steps, or when a step lowers the value by less than
    ``tolerance`` of it."""
    x, (value, gradient) = np.array(start, float), evaluate(start)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(max_iter):
        way, kept = gradient.copy(), []
        for s, y, rho in reversed(moves):
            a = rho * (s @ way)
            way -= a * y
            kept.append(a)
        if moves:
            s, y, _ = moves[-1]
            way *= (s @ y) / (y @ y)
        else:
            way /= max(np.linalg.norm(way), 1.0)
        for (s, y, rho), a in zip(moves, reversed(kept)):
            way += (a - rho * (y @ way)) * s
        slope = gradient @ way
        if slope <= 0:  # not a way down: steepest descent again
            way, moves, slope = gradient.copy(), [], float(gradient @ gradient)
        if not slope:
            break
        step = 1.0
        while True:
            moved = x - step * way
            new, new_gradient = evaluate(moved)
            if np.isfinite(new) and new <= value - 1e-4 * step * slope:
                break
            step /= 2
            if step < 1e-12:
                return x, value
        s, y = moved - x, new_gradient - gradient
        if s @ y > 1e-12 * (y @ y):
            moves = [*moves, (s, y, 1 / (s @ y))][-MEMORY:]
        gain, x, value, gradient = value - new, moved, new, new_gradient
        if gain <= tolerance * max(abs(value), 1e-12):
            break
    return x, value
