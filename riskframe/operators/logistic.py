"""Binary logistic regression by Newton steps.

The rows are written once as blocks of floats.  A step is one pass over the
blocks: a task sends the loss, gradient and Hessian of its rows, a few hundred
numbers.  Some ten passes reach the optimum of the objective (weighted log
loss + L2 penalty on the coefficients) that the quasi-Newton solver of
``LogisticRegression`` nears in tens to hundreds, each over its own copy of
the rows in memory or, where they do not fit, on disk.  Fits that leave out a
fold each read the same blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import saved, workers_import

#: Passes at most, and the decrease relative to the loss after which a step is the last.
MAX_PASSES, TOLERANCE = 100, 1e-10
#: Rows of a block: Parquet looks at the size of what it holds after a hundred of them.
BLOCK_ROWS = 1000
WRITTEN = {"compression": "zstd", "parquet.enable.dictionary": "false", "parquet.block.size": str(16 << 20)}


def blocks(df: DataFrame, features, label: str, fold_col: str | None = None) -> DataFrame:
    """The features, label and fold of the rows as written blocks, a
    column after another; a null or NaN is an error."""
    workers_import(df.sparkSession)
    cols = [F.col(f"`{c}`").cast("double") for c in (*features, label, *([fold_col] if fold_col else []))]

    def pack(batches):
        for b in batches:
            x = np.empty((b.num_columns, b.num_rows))
            for i, c in enumerate(b.columns):
                if c.null_count:
                    raise ValueError("logistic regression needs features and labels without nulls: impute them first")
                x[i] = c.to_numpy(zero_copy_only=False)
            if np.isnan(x).any():
                raise ValueError("logistic regression needs features and labels without NaN: impute them first")
            parts = [x[:, i:i + BLOCK_ROWS] for i in range(0, b.num_rows, BLOCK_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array([p.shape[1] for p in parts], pa.int32()),
                                              pa.array([p.tobytes() for p in parts], pa.binary())], ["n", "block"])

    return saved(df.select(*[c.alias(f"x{i}") for i, c in enumerate(cols)]).mapInArrow(pack, "n int, block binary"), WRITTEN)


def _at(rows: DataFrame, beta: np.ndarray, weights: dict, held_out=None):
    """Loss, gradient and Hessian at ``beta`` without the penalty, and the
    smallest and largest value of each feature."""
    d, w0, w1 = len(beta), weights[0], weights[1]

    def run(batches):
        loss, grad, hess = 0.0, np.zeros(d), np.zeros((d, d))
        low, high = np.full(d - 1, np.inf), np.full(d - 1, -np.inf)
        for b in batches:
            for n, block in zip(b.column("n").to_pylist(), b.column("block")):
                x = np.frombuffer(block.as_buffer()).reshape(-1, n)
                if held_out is not None:
                    x = x[:, x[d] != held_out]
                    if not x.shape[1]:
                        continue
                y = x[d - 1]
                low, high = np.minimum(low, x[:d - 1].min(axis=1)), np.maximum(high, x[:d - 1].max(axis=1))
                x = np.vstack([x[:d - 1], np.ones_like(y)])
                w = np.where(y > 0.5, w1, w0)
                m = beta @ x
                e = np.exp(-np.abs(m))
                p = np.where(m >= 0, 1.0, e) / (1.0 + e)
                loss += w @ (np.maximum(m, 0) - m * y + np.log1p(e))
                grad += x @ (w * (p - y))
                hess += (x * (w * p * (1 - p))) @ x.T
        yield pa.RecordBatch.from_arrays([pa.array([[loss, *grad, *hess.ravel(), *low, *high]], pa.list_(pa.float64()))], ["sums"])

    parts = np.array([p["sums"] for p in rows.mapInArrow(run, "sums array<double>").collect()])  # a few hundred numbers a task
    total = parts[:, :1 + d + d * d].sum(axis=0)
    low, high = np.split(parts[:, 1 + d + d * d:], 2, axis=1)
    return total[0], total[1:1 + d], total[1 + d:].reshape(d, d), low.min(axis=0), high.max(axis=0)


def fit_logistic(rows: DataFrame, n_features: int, weights: dict, penalty: float, held_out=None) -> tuple[np.ndarray, float]:
    """Coefficients and intercept from ``blocks`` with labels 0 and 1, both
    present, whose rows weigh ``weights[label]``; the fold ``held_out`` has no
    part.  The intercept is not penalised, and a constant feature gets the
    coefficient 0, as in ``LogisticRegression``."""
    d = n_features + 1
    ridge = np.append(np.full(d - 1, penalty), 0.0)
    beta = trial = step = np.zeros(d)
    least = None
    for _ in range(MAX_PASSES):
        loss, grad, hess, low, high = _at(rows, trial, weights, held_out)
        loss, grad, hess = loss + ridge @ (trial * trial) / 2, grad + ridge * trial, hess + np.diag(ridge)
        if least is not None and not loss <= least * (1 + 1e-12):  # too far: half the way
            step = step / 2
            trial = beta + step
            continue
        beta, least = trial, loss
        free = np.flatnonzero(np.append(low < high, True))
        step = np.zeros(d)
        step[free] = -np.linalg.lstsq(hess[np.ix_(free, free)], grad[free], rcond=None)[0]
        trial = beta + step
        if -(grad @ step) / 2 <= TOLERANCE * loss:
            return trial[:-1], float(trial[-1])  # what this step leaves is far smaller still
    return beta[:-1], float(beta[-1])
