"""Logistic regression with its penalty chosen by cross-validation, all folds and penalties fitted together.

A pass over the rows gives loss, gradient and curvature of every (fold, penalty) at once, summed by the
workers: Newton's method then needs about ten passes for the whole grid, where one fit after another needs
as many for each point. One more pass counts the held-out rows by class of margin, for the areas under the
ROC curves. Rows are laid in blocks once, as passing them one by one to the workers takes most of a pass.
The chosen penalty is fitted by Spark ML on all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrules.session import cut

AREA_CLASSES = 8_192  # classes of margin in which held-out rows are counted
BLOCK_ROWS = 8_192  # rows that travel together
FILE_BLOCKS = 64  # blocks of a file, which a reader may take into memory at once


@dataclass(frozen=True)
class TunedLogistic:
    """An estimator over ``label`` (0 or 1) and ``features``; ``fit`` gives the model of the best penalty."""

    penalties: tuple[float, ...]
    folds: int = 2
    rounds: int = 100
    seed: int = 42

    def fit(self, train: DataFrame) -> LogisticRegressionModel:
        areas = self.areas(train)
        best = self.penalties[int(np.argmax(areas.mean(axis=0)))] if len(areas) else self.penalties[0]
        return LogisticRegression(regParam=best, maxIter=self.rounds).fit(train)

    def areas(self, train: DataFrame) -> np.ndarray:
        """(fold, penalty): the area under the ROC curve of the fold's rows, by models of the other folds."""
        first = train.select("features").first()
        if first is None:
            return np.zeros((0, len(self.penalties)))
        names = [f"x{i}" for i in range(len(first[0]))]
        x = vector_to_array("features")
        fold = F.least(F.floor(F.rand(self.seed) * self.folds), F.lit(self.folds - 1)).cast("int")
        rows = cut(train.select(F.col("label").cast("double").alias("y"), fold.alias("fold"), x.alias("x")).select("y", "fold", *[F.col("x")[i].alias(n) for i, n in enumerate(names)]))
        scale = _scales(rows, names, self.folds)
        blocks = _laid(rows, names)
        weights = _fitted(blocks, names, scale, self.penalties, self.rounds)
        return _areas(blocks, names, scale, weights)


@dataclass(frozen=True)
class _Scale:
    """Of a fold's training rows: their number and positives, mean and deviation of the features."""

    n: int
    positives: float
    mean: np.ndarray
    deviation: np.ndarray

    def of(self, x: list[np.ndarray], mine: np.ndarray) -> np.ndarray:
        """(feature, row) of some rows: centred and scaled, 0 where a feature does not vary; then 1 for the intercept."""
        out = np.empty((len(x) + 1, len(mine)))
        out[-1] = 1
        for i, (column, mean, deviation) in enumerate(zip(x, self.mean, self.deviation)):
            out[i] = (column[mine] - mean) / deviation if deviation > 0 else 0
        return out


def _scales(rows: DataFrame, names: Sequence[str], folds: int) -> list[_Scale]:
    wanted = [F.count_if(F.col("y").isNull() | ~F.col("y").isin(0.0, 1.0)).alias("odd")]
    for k in range(folds):
        mine = F.col("fold") != k
        wanted += [F.count_if(mine).alias(f"n{k}"), F.sum(F.when(mine, F.col("y"))).alias(f"p{k}")]
        wanted += [made(F.when(mine, F.col(c))).alias(f"{m}{k}{c}") for c in names for m, made in (("m", F.avg), ("s", F.stddev_samp))]
    found = rows.agg(*wanted).first()
    if found["odd"]:
        raise ValueError(f"{found['odd']} labels are neither 0 nor 1")
    numbers = lambda m, k: np.array([found[f"{m}{k}{c}"] or 0.0 for c in names])
    return [_Scale(found[f"n{k}"], found[f"p{k}"] or 0.0, numbers("m", k), numbers("s", k)) for k in range(folds)]


def _laid(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows as a written table of blocks of ``BLOCK_ROWS``, however many a batch has: labels, folds and features after one another."""
    columns = [("y", "<f8"), ("fold", "<i4"), *((n, "<f8") for n in names)]

    def work(batches):
        held, n = [], 0

        def block():
            part = pa.Table.from_batches(held)
            y, fold, *x = (part.column(c).to_numpy().astype(kind).tobytes() for c, kind in columns)
            return pa.record_batch([pa.array([v], pa.binary()) for v in (y, fold, b"".join(x))], names=["y", "fold", "x"])

        for batch in batches:
            while len(batch):
                held.append(batch.slice(0, BLOCK_ROWS - n))
                batch, n = batch.slice(len(held[-1])), n + len(held[-1])
                if n == BLOCK_ROWS:
                    yield block()
                    held, n = [], 0
        if held:
            yield block()

    return cut(rows.mapInArrow(work, "y binary, fold binary, x binary"), FILE_BLOCKS)


def _blocks(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    for batch in batches:
        for i in range(len(batch)):
            y, fold, x = (np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in (("y", "<f8"), ("fold", "<i4"), ("x", "<f8")))
            yield y, fold, list(x.reshape(len(names), len(y)))


def _sums(blocks: DataFrame, names: Sequence[str], scale: list[_Scale], weights: np.ndarray) -> np.ndarray:
    """(fold, value, penalty): summed loss, gradient and upper triangle of the curvature at the weights."""
    size = weights.shape[1]
    left, right = np.triu_indices(size)

    def work(batches):
        total = np.zeros((len(scale), 1 + size + len(left), weights.shape[2]))
        for y, fold, x in _blocks(batches, names):
            for k, s in enumerate(scale):
                mine = np.flatnonzero(fold != k)
                z, hit = s.of(x, mine), y[mine]
                margin = weights[k].T @ z
                low = np.exp(-np.abs(margin))
                total[k, 0] += (np.log(1 + low) + np.maximum(margin, 0)).sum(axis=1) - margin @ hit
                low /= 1 + low  # the lesser of a row's two probabilities
                total[k, 1 : 1 + size] += z @ np.where(margin >= 0, 1 - low, low).T - (z @ hit)[:, None]
                low *= 1 - low
                total[k, 1 + size :] += (z[left] * z[right]) @ low.T
        yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "value"])

    found = blocks.mapInArrow(work, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(len(scale) * (1 + size + len(left)) * weights.shape[2])
    out[found.column("at").to_numpy()] = found.column("value").to_numpy()
    return out.reshape(len(scale), -1, weights.shape[2])


def _fitted(blocks: DataFrame, names: Sequence[str], scale: list[_Scale], penalties: Sequence[float], rounds: int) -> np.ndarray:
    """(fold, feature or intercept, penalty): weights of least mean loss and half the penalty times the sum of
    squares, on scaled features. A step that does not lower this enough is halved; each trial is a pass."""
    size = len(names) + 1
    left, right = np.triu_indices(size)
    now = np.zeros((len(scale), size, len(penalties)))
    grid = []
    for k, s in enumerate(scale):
        if 0 < s.positives < s.n:  # otherwise all scores are equal
            now[k, -1] = np.log(s.positives / (s.n - s.positives))
            grid += [(k, i) for i in range(len(penalties))]
    trial, step, best, fall = now.copy(), np.zeros_like(now), {}, {}
    for _ in range(rounds):
        if not grid:
            break
        sums = _sums(blocks, names, scale, trial)
        for k, i in list(grid):
            penalty, w = np.append(np.full(size - 1, penalties[i]), 0.0), trial[k, :, i]
            mean = sums[k, :, i] / scale[k].n
            loss = mean[0] + penalty @ w**2 / 2
            if (k, i) in best and not loss <= best[k, i] - 1e-4 * fall[k, i] + 1e-12 * abs(best[k, i]):
                step[k, :, i] /= 2
                fall[k, i] /= 2
                trial[k, :, i] = now[k, :, i] + step[k, :, i]
                if fall[k, i] <= 1e-12 * abs(best[k, i]):
                    grid.remove((k, i))
                continue
            now[k, :, i], best[k, i] = w, loss
            slope, bend = mean[1 : 1 + size] + penalty * w, np.diag(penalty)
            bend[left, right] += mean[1 + size :]
            bend[right, left] = bend[left, right]
            step[k, :, i] = -np.linalg.pinv(bend, hermitian=True) @ slope
            fall[k, i] = -slope @ step[k, :, i]
            trial[k, :, i] = w + step[k, :, i]
            if fall[k, i] <= 1e-8 * abs(loss):  # the next step would be of the order of its square
                now[k, :, i] = trial[k, :, i]
                grid.remove((k, i))
    return now


def _areas(blocks: DataFrame, names: Sequence[str], scale: list[_Scale], weights: np.ndarray) -> np.ndarray:
    """(fold, penalty): areas under the ROC curves of the held-out rows, counted in classes of the margin."""
    folds, _, points = weights.shape
    # Margins lie about the intercept; classes are narrow there and wide far out.
    middle, width = weights[:, -1:], np.sqrt((weights[:, :-1] ** 2).sum(axis=1, keepdims=True))
    width = np.where(width > 0, width, 1.0)

    def work(batches):
        total = np.zeros((folds, points, 2 * AREA_CLASSES), np.int64)
        for y, fold, x in _blocks(batches, names):
            for k, s in enumerate(scale):
                mine = np.flatnonzero(fold == k)
                far = (s.of(x, mine).T @ weights[k] - middle[k]) / width[k]
                place = ((far / (1 + np.abs(far)) + 1) * (AREA_CLASSES // 2)).astype(np.int64).clip(0, AREA_CLASSES - 1)
                cell = 2 * place + (y[mine] > 0)[:, None]
                for i in range(points):
                    total[k, i] += np.bincount(cell[:, i], minlength=2 * AREA_CLASSES)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total.ravel()[at])], names=["at", "n"])

    # At most two counts per class, fold and penalty.
    found = blocks.mapInArrow(work, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(folds * points * 2 * AREA_CLASSES)
    counts[found.column("at").to_numpy()] = found.column("n").to_numpy()
    negatives, positives = np.moveaxis(counts.reshape(folds, points, AREA_CLASSES, 2), 3, 0)
    wins = (positives * (np.cumsum(negatives, axis=2) - negatives / 2)).sum(axis=2)
    pairs = positives.sum(axis=2) * negatives.sum(axis=2)
    return np.divide(wins, pairs, out=np.full((folds, points), 0.5), where=pairs > 0)
