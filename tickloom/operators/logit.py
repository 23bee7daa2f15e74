"""Logistic models of all folds and strengths at once, fitted exactly by Newton steps.

A grid search of 5 strengths over 5 folds is 25 models that read the same rows.  They are
fitted together: a step is one pass over the stored rows, in which every task sums the
gradients and Hessians of all models with BLAS; the sums are grouped by model, and the driver
solves one small system per model.  Some eight passes fit the whole grid, however many models
it has, and the result does not depend on a learning rate or a stopping rule.

The penalty is that of an inverse strength C: sum of losses + |w|^2 / (2 C), the intercept
free.  Features are scaled by the mean and sample deviation of a model's own training rows.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F

from tickloom.operators.models import C_GRID, FOLDS, ordered_folds
from tickloom.session import stored

MOST_STEPS = 50
CLOSE = 1e-10


@dataclass(frozen=True)
class Grid:
    """Fitted models: ``sets`` holds (fold left out or None, C) of each row of ``weights``.

    ``weights`` are those of scaled features, the intercept first; ``mean`` and ``scale`` have one
    row per fold and a last one for the fit over all rows.
    """

    columns: tuple
    sets: tuple
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    accuracy: np.ndarray
    steps: int

    def scores(self):
        """Mean accuracy over the folds left out, per C."""
        out = {}
        for c in sorted({c for _, c in self.sets}):
            out[c] = float(np.mean([a for (f, k), a in zip(self.sets, self.accuracy) if k == c and f is not None]))
        return out

    def best(self):
        """The C of the highest score; the smallest one on a tie."""
        scores = self.scores()
        return max(sorted(scores), key=scores.get)

    def plain(self, c):
        """Intercept and coefficients of unscaled features of the fit over all rows."""
        w = self.weights[self.sets.index((None, c))]
        slopes = w[1:] / self.scale[-1]
        return float(w[0] - slopes @ self.mean[-1]), dict(zip(self.columns, slopes.tolist()))

    def table(self, spark):
        """One row per model: c, fold (NULL: all rows), intercept, coefficients (scaled), accuracy on the rows left out
        (on all rows where none is)."""
        rows = [
            (float(c), f, float(w[0]), [float(x) for x in w[1:]], float(a))
            for (f, c), w, a in zip(self.sets, self.weights, self.accuracy)
        ]
        return spark.createDataFrame(rows, "c double, fold int, intercept double, coefficients array<double>, accuracy double")


def fit_grid(train, columns, label="target", grid=C_GRID, folds=FOLDS, order="date"):
    """Fit a model per C to all rows but those of a fold, for every fold, and one per C to all rows.

    ``label`` is 0 or 1.  Rows with a NULL in a feature or the label must be gone (``dropna``).
    """
    columns = tuple(columns)
    folded = ordered_folds(train.select(order, label, *columns), folds, label, order)
    rows, _ = stored(folded.select(F.col("_fold"), F.col(label).cast("double").alias("_y"), *[F.col(c).cast("double") for c in columns]), "folds")
    mean, scale = _scales(rows, columns, folds)
    sets = tuple((f, c) for f in (*range(folds), None) for c in grid)
    ridge = np.array([1 / c for _, c in sets])
    part = np.array([folds if f is None else f for f, _ in sets])
    width = len(columns) + 1
    w = np.zeros((len(sets), width))
    step, before, steps = np.zeros_like(w), np.full(len(sets), np.inf), 0
    open_ = np.ones(len(sets), bool)
    while open_.any() and steps < MOST_STEPS:
        loss, slope, curve = _sums(rows, columns, mean, scale, part, w, open_)
        steps += 1
        loss += ridge * (w[:, 1:] ** 2).sum(1) / 2
        for m in np.flatnonzero(open_):
            if loss[m] > before[m] + 1e-9 * abs(before[m]):  # too far: half the way back
                step[m] /= 2
                w[m] += step[m]
                continue
            before[m] = loss[m]
            penalty = np.r_[0.0, np.full(width - 1, ridge[m])]
            step[m] = np.linalg.solve(curve[m] + np.diag(penalty) + 1e-12 * np.eye(width), slope[m] + penalty * w[m])
            w[m] -= step[m]
            open_[m] = np.abs(step[m]).max() > CLOSE
    return Grid(columns, sets, w, mean, scale, _accuracy(rows, columns, mean, scale, part, w, folds), steps)


def _scales(rows, columns, folds):
    """Mean and sample deviation of the rows outside each fold, and of all rows, from one aggregate per fold."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        aggs += [F.avg(c).alias(f"m{i}"), F.var_pop(c).alias(f"v{i}")]
    found = {r["_fold"]: r for r in rows.groupBy("_fold").agg(*aggs).collect()}  # one row per fold
    mean, scale = np.zeros((folds + 1, len(columns))), np.ones((folds + 1, len(columns)))
    for s in range(folds + 1):
        used = [r for f, r in found.items() if f != s]
        n = sum(r["n"] for r in used)
        if not n:
            continue
        for i in range(len(columns)):
            mean[s, i] = sum(r["n"] * r[f"m{i}"] for r in used) / n
            squares = sum(r["n"] * (r[f"v{i}"] + (r[f"m{i}"] - mean[s, i]) ** 2) for r in used)
            if n > 1 and squares > 0:
                scale[s, i] = np.sqrt(squares / (n - 1))
    return mean, scale


def _reader(columns, mean, scale):
    """A function of its own (workers needn't have this package): scaled features of a set, labels and folds of a batch."""

    def read(batch):
        x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
        y, fold = batch.column("_y").to_numpy(), batch.column("_fold").to_numpy()
        return y, fold, lambda used, s: np.column_stack([np.ones(used.sum()), (x[used] - mean[s]) / scale[s]])

    return read


def _sums(rows, columns, mean, scale, part, w, open_):
    """Loss, gradient and Hessian of every open model, one grouped sum of what the tasks found."""
    width = w.shape[1]
    upper = np.triu_indices(width)
    models = np.flatnonzero(open_).tolist()
    folds = mean.shape[0] - 1
    read = _reader(columns, mean, scale)

    def add(batches):
        import pyarrow as pa

        found = np.zeros((len(models), 1 + width + len(upper[0])))
        for batch in batches:
            y, fold, scaled = read(batch)
            for s in sorted({int(part[m]) for m in models}):
                used = np.ones(len(y), bool) if s == folds else fold != s
                z, t = scaled(used, s), y[used]
                for k, m in enumerate(models):
                    if part[m] != s:
                        continue
                    g = z @ w[m]
                    p = 0.5 * (1 + np.tanh(g / 2))
                    found[k, 0] += (np.logaddexp(0, g) - t * g).sum()
                    found[k, 1 : 1 + width] += z.T @ (p - t)
                    found[k, 1 + width :] += ((z * (p * (1 - p))[:, None]).T @ z)[upper]
        k, at = np.indices(found.shape).reshape(2, -1)
        model = np.array(models, np.int32)[k]
        yield pa.RecordBatch.from_arrays([pa.array(model), pa.array(at.astype(np.int32)), pa.array(found.ravel())], ["model", "at", "v"])

    total = rows.mapInArrow(add, "model int, at int, v double").groupBy("model", "at").agg(F.sum("v").alias("v"))
    loss, slope, curve = np.zeros(len(w)), np.zeros_like(w), np.zeros((len(w), width, width))
    for m, at, v in total.collect():  # models x (their parameters squared)
        if at == 0:
            loss[m] = v
        elif at <= width:
            slope[m, at - 1] = v
        else:
            i, j = upper[0][at - 1 - width], upper[1][at - 1 - width]
            curve[m, i, j] = curve[m, j, i] = v
    return loss, slope, curve


def _accuracy(rows, columns, mean, scale, part, w, folds):
    """Share of right answers of every model on the rows it did not see (all rows where it saw all)."""

    read = _reader(columns, mean, scale)

    def count(batches):
        import pyarrow as pa

        hits, seen = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)
        for batch in batches:
            y, fold, scaled = read(batch)
            for m in range(len(w)):
                s = part[m]
                used = np.ones(len(y), bool) if s == folds else fold == s
                said = scaled(used, s) @ w[m] > 0
                hits[m] += (said == (y[used] > 0.5)).sum()
                seen[m] += used.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(w), dtype=np.int32)), pa.array(hits), pa.array(seen)], ["model", "hits", "n"])

    out = np.zeros(len(w))
    for m, hits, n in rows.mapInArrow(count, "model int, hits long, n long").groupBy("model").agg(F.sum("hits"), F.sum("n")).collect():
        out[m] = hits / n if n else np.nan
    return out
