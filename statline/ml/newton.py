"""Newton's method for the logistic and Huber models from passes of sums.

Both losses are convex and have few parameters (features x classes), so a pass
over the rows that adds up loss, gradient and second derivatives is worth dozens
of gradient steps: the fits of Spark ML took hundreds of passes, one or more jobs
each, to the same minimum. All problems of a cross-validation share a pass: a
row adds to the sums of every fold but its own. What reaches the driver are sums
of the size parameters², added up by a few tasks first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import workers_import_package

#: Key of the problem of all rows; other keys are the fold that a problem leaves out.
ALL = -1
ROWS_PER_STEP = 4096
#: Tasks that add up the sums of all partitions.
ADDERS = 8


@dataclass(frozen=True)
class Design:
    """The model's inputs from scaled columns: these, or √(2/D)·cos(W·x + b) of them, and a constant."""

    cols: tuple[str, ...]
    weights: np.ndarray | None = None
    offsets: np.ndarray | None = None

    @property
    def width(self) -> int:
        return (len(self.cols) if self.weights is None else len(self.weights)) + 1

    def matrix(self, x: np.ndarray) -> np.ndarray:
        if self.weights is not None:
            x = math.sqrt(2.0 / len(self.weights)) * np.cos(x @ self.weights.T + self.offsets)
        return np.hstack([x, np.ones((len(x), 1))])


@dataclass(frozen=True)
class Logistic:
    """Multinomial cross-entropy with ½·reg·|w|² over the weights of all classes, intercepts free.

    Parameters are the classes' differences from the last one; the penalty of the symmetric weights
    that sum to 0 over classes, which is where its minimum lies, is a quadratic form of these.
    """

    width: int
    classes: int
    reg: float

    def start(self, n: float, s: float, q: float) -> np.ndarray:
        return np.zeros((self.classes - 1) * self.width)

    def scores(self, x: np.ndarray, theta: np.ndarray) -> np.ndarray:
        return np.hstack([x @ theta.reshape(-1, self.width).T, np.zeros((len(x), 1))])

    def sums(self, x: np.ndarray, y: np.ndarray, theta: np.ndarray) -> np.ndarray:
        eta, k, p = self.scores(x, theta), self.classes - 1, self.width
        eta -= eta.max(axis=1, keepdims=True)
        at = y.astype(np.int64)
        prob = np.exp(eta)
        total = prob.sum(axis=1, keepdims=True)
        loss = np.log(total[:, 0]).sum() - eta[np.arange(len(y)), at].sum()
        prob /= total
        left = prob[:, :k].copy()
        known = at < k
        left[np.flatnonzero(known), at[known]] -= 1.0
        hess = np.empty((k * (k + 1) // 2, p, p))
        pairs = ((a, b) for a in range(k) for b in range(a, k))
        for i, (a, b) in enumerate(pairs):
            w = prob[:, a] * ((a == b) - prob[:, b])
            hess[i] = x.T @ (x * w[:, None])
        return np.concatenate([[len(y), loss], (left.T @ x).ravel(), hess.ravel()])

    def objective(self, sums: np.ndarray, theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        k, p = self.classes - 1, self.width
        n, m = max(sums[0], 1.0), k * p
        grad, hess = sums[2:2 + m] / n, np.zeros((k, p, k, p))
        pairs = ((a, b) for a in range(k) for b in range(a, k))
        for block, (a, b) in zip(sums[2 + m:].reshape(-1, p, p), pairs):
            hess[a, :, b, :] = hess[b, :, a, :] = block / n
        form = self.reg * np.kron(np.eye(k) - 1.0 / self.classes, np.diag([1.0] * (p - 1) + [0.0]))
        return (sums[1] / n + 0.5 * float(theta @ form @ theta), grad + form @ theta, hess.reshape(m, m) + form)

    def allowed(self, theta: np.ndarray, step: np.ndarray) -> float:
        return 1.0

    def weights(self, theta: np.ndarray) -> np.ndarray:
        """(classes, width): weights and intercepts that sum to 0 over the classes."""
        full = np.vstack([theta.reshape(-1, self.width), np.zeros(self.width)])
        return full - full.mean(axis=0)

    def checks(self, x: np.ndarray, y: np.ndarray, theta: np.ndarray) -> list[float]:
        return [len(y), float((self.scores(x, theta).argmax(axis=1) == y).sum())]

    def score(self, n: float, hits: float) -> float:
        return hits / n if n else float("nan")


@dataclass(frozen=True)
class Huber:
    """½(σ + H(r/σ)·σ) with the scale σ as the last parameter, and ½·reg·|w|² (Owen, 2007), as in Spark ML."""

    width: int
    reg: float
    epsilon: float = 1.35

    def start(self, n: float, s: float, q: float) -> np.ndarray:
        mean = s / max(n, 1.0)
        spread = math.sqrt(max(q / max(n, 1.0) - mean * mean, 0.0))
        return np.concatenate([np.zeros(self.width - 1), [mean, spread or 1.0]])

    def sums(self, x: np.ndarray, y: np.ndarray, theta: np.ndarray) -> np.ndarray:
        sigma, m, p = theta[-1], self.epsilon, self.width
        r = x @ theta[:-1] - y
        inner = np.abs(r) <= m * sigma
        ri, xi = r[inner], x[inner]
        outer = r[~inner]
        loss = 0.5 * (len(y) * sigma + ri @ ri / sigma + (2 * m * np.abs(outer) - m * m * sigma).sum())
        grad = np.empty(p + 1)
        grad[:p] = xi.T @ ri / sigma + m * (x[~inner].T @ np.sign(outer))
        grad[p] = 0.5 * (len(y) - ri @ ri / sigma ** 2 - m * m * len(outer))
        hess = np.empty((p + 1, p + 1))
        hess[:p, :p] = xi.T @ xi / sigma
        hess[:p, p] = hess[p, :p] = -(xi.T @ ri) / sigma ** 2
        hess[p, p] = ri @ ri / sigma ** 3
        return np.concatenate([[len(y), loss], grad, hess.ravel()])

    def objective(self, sums: np.ndarray, theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        n, m = max(sums[0], 1.0), self.width + 1
        form = self.reg * np.diag([1.0] * (m - 2) + [0.0, 0.0])
        return (sums[1] / n + 0.5 * float(theta @ form @ theta), sums[2:2 + m] / n + form @ theta,
                sums[2 + m:].reshape(m, m) / n + form)

    def allowed(self, theta: np.ndarray, step: np.ndarray) -> float:
        """The part of a step after which σ is at least a tenth of what it was."""
        return 1.0 if step[-1] >= -0.9 * theta[-1] else float(-0.9 * theta[-1] / step[-1])

    def weights(self, theta: np.ndarray) -> np.ndarray:
        return theta[None, :-1]

    def checks(self, x: np.ndarray, y: np.ndarray, theta: np.ndarray) -> list[float]:
        r = x @ theta[:-1] - y
        return [len(y), float(r @ r), float(y.sum()), float(y @ y)]

    def score(self, n: float, left: float, s: float, q: float) -> float:
        all_ = q - s * s / n if n else 0.0
        return 1 - left / all_ if all_ > 0 else float("nan")


def _steps(batches: Iterator[pa.RecordBatch], design: Design) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(inputs, label, fold) of a few thousand rows at a time."""
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        for i in range(0, batch.num_rows, ROWS_PER_STEP):
            part = [c[i:i + ROWS_PER_STEP] for c in cols]
            yield design.matrix(np.column_stack(part[:-2]).astype(float)), part[-2].astype(float), part[-1]


def _add(total: dict[int, np.ndarray], key: int, sums: np.ndarray) -> None:
    if key in total:
        total[key] += sums
    else:
        total[key] = np.array(sums, dtype=float)


def _emit(total: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for key, sums in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["key", "sums"])


def _collect(rows: DataFrame, partial) -> dict[int, np.ndarray]:
    """Sums by key of what ``partial`` yields for the rows of each partition."""
    def within(batches):
        total: dict[int, np.ndarray] = {}
        for key, sums in partial(batches):
            _add(total, key, sums)
        yield from _emit(total)

    def across(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _add(total, key, np.frombuffer(sums))
        yield from _emit(total)

    workers_import_package(rows.sparkSession)
    schema = "key int, sums binary"
    total: dict[int, np.ndarray] = {}
    for row in rows.mapInArrow(within, schema).repartition(ADDERS).mapInArrow(across, schema).collect():
        _add(total, row["key"], np.frombuffer(row["sums"]))
    return total


def minimise(rows: DataFrame, design: Design, loss, starts: dict[int, np.ndarray], max_iter: int = 1000,
             tol: float = 1e-11) -> dict[int, np.ndarray]:
    """The minimum of every problem of ``starts``: key -> parameters, damped Newton steps, one pass for all problems.

    ``rows`` has the design's columns, the label and the fold. A problem is done when its next step promises to lower
    the objective by less than ``tol`` of it; that step is still taken.
    """
    at, base, step, size = dict(starts), {}, {}, {}
    trial, done = dict(starts), {}
    for _ in range(max_iter):
        if not trial:
            break
        thetas = dict(trial)

        def partial(batches, thetas=thetas):
            for x, y, fold in _steps(batches, design):
                for key, theta in thetas.items():
                    if key == ALL:
                        yield key, loss.sums(x, y, theta)
                    else:
                        keep = fold != key
                        yield key, loss.sums(x[keep], y[keep], theta)

        got = _collect(rows, partial)
        for key, theta in thetas.items():
            if key not in got:  # no rows
                done[key] = trial.pop(key)
                continue
            value, grad, hess = loss.objective(got[key], theta)
            if key in base and not value <= base[key][0] + 1e-4 * size[key] * base[key][1]:
                size[key] /= 4
                if size[key] < 1e-9:
                    done[key] = at[key]
                    trial.pop(key)
                else:
                    trial[key] = at[key] + size[key] * step[key]
                continue
            at[key] = theta
            ridge = 1e-14 * max(float(np.trace(hess)) / max(len(hess), 1), 1e-300)
            move = -np.linalg.lstsq(hess + ridge * np.eye(len(hess)), grad, rcond=None)[0]
            slope = float(grad @ move)
            base[key], step[key] = (value, slope), move
            size[key] = loss.allowed(theta, move)
            trial[key] = theta + size[key] * move
            if -slope <= tol * max(abs(value), 1e-3) or not np.isfinite(trial[key]).all():
                done[key] = trial.pop(key) if np.isfinite(trial[key]).all() else trial.pop(key) * 0 + theta
    return {key: done.get(key, at[key]) for key in starts}


def label_sums(rows: DataFrame, label: str) -> tuple[float, float, float]:
    """Count, sum and sum of squares of the label."""
    n, s, q = rows.selectExpr("count(1)", f"sum(`{label}`)", f"sum(`{label}` * `{label}`)").first()
    return float(n), float(s or 0.0), float(q or 0.0)


def fold_scores(rows: DataFrame, design: Design, loss, thetas: dict[int, np.ndarray]) -> dict[int, float]:
    """r² or accuracy of every fold by the model that left it out, in one pass."""
    def partial(batches):
        for x, y, fold in _steps(batches, design):
            for key, theta in thetas.items():
                own = fold == key
                if own.any():
                    yield key, np.array(loss.checks(x[own], y[own], theta))

    got = _collect(rows, partial)
    return {key: loss.score(*got[key]) for key in thetas if key in got}


def statement(loss, theta: np.ndarray, inputs: Sequence[str]) -> str:
    """The fitted model as SQL over ``inputs``, for a pipeline stage: ``prediction``, and ``probability`` of each class."""
    sums = [" + ".join([f"{float(row[-1])!r}D", *[f"`{c}` * {float(w)!r}D" for c, w in zip(inputs, row)]])
            for row in loss.weights(theta)]
    if isinstance(loss, Huber):
        return f"SELECT *, {sums[0]} AS prediction FROM __THIS__"
    best = "array_max(__margins)"
    shares = f"transform(__margins, x -> exp(x - {best}))"
    return (f"SELECT * EXCEPT (__margins), CAST(array_position(__margins, {best}) - 1 AS DOUBLE) AS prediction, "
            f"transform({shares}, x -> x / aggregate({shares}, 0D, (a, v) -> a + v)) AS probability "
            f"FROM (SELECT *, array({', '.join(sums)}) AS __margins FROM __THIS__)")
