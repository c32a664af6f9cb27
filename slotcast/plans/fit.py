"""Fit a next-step forecaster (re-aimed from a single-machine network fit): linear regression over the
flat window, a small grid of regularisations, the lowest validation MSE kept.

No window is built.  One pass over the rows gives the windows' second moments
(``operators.lagged``), a matrix whose size follows the window, not the data; every regularisation is
solved from it, and the errors on both parts of the split follow from it too."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast.operators import lagged as L
from slotcast.plans.scoring import LinearModel

REG_PARAMS = (0.0, 0.01, 10.0)
#: Scaled columns of a window's row, in the order of the flat window.
VALUES = ("car_count", "hour")
FLAT = 1e-12  # share of a second moment below which a variance is rounding only


def _values() -> list[Column]:
    return [F.col("car_count").cast("double") / F.lit(C.CAR_MAX), F.hour("ts").cast("double") / F.lit(C.HOUR_MAX)]


def split_part(n: int = C.N_STEPS, start: float = C.VALID_START_FRACTION, end: float = C.VALID_END_FRACTION) -> Column:
    """Part of the split (train, valid) of the window that starts at row ``idx`` of ``n_rows``; null where none starts."""
    windows = F.col("n_rows") - n
    at = [F.floor(windows.cast("double") * F.lit(float(x))) for x in (start, end)]
    inside = (F.col("idx") >= at[0]) & (F.col("idx") < at[1])
    return F.when(F.col("idx") < windows, F.when(inside, F.lit("valid")).otherwise(F.lit("train")))


def fit_sums(rows: DataFrame, n: int = C.N_STEPS) -> DataFrame:
    """The windows' summed products from indexed rows (``plans.training.indexed_rows``), per part of the split."""
    return L.window_sums(rows, n, _values(), split_part(n))


@dataclass
class Moments:
    """Counts, means and centred second moments of the flat windows and their label, which is the last place."""

    n: float
    mean: np.ndarray
    centred: np.ndarray

    def error(self, weights: np.ndarray, bias: float) -> float:
        """Mean squared error of a linear forecast."""
        w = np.append(weights, -1.0)
        off = float(self.mean @ w) + bias
        return float(w @ self.centred @ w / self.n + off * off)


def part_moments(collected: list, n: int = C.N_STEPS) -> dict[str, Moments]:
    """From the rows of ``fit_sums``, whose number follows the window alone."""
    width = len(VALUES) + 1
    out = {}
    for part in sorted({r.part for r in collected}):
        lags, edges = np.zeros((n + 1, width * width)), np.zeros((n * width, n * width))
        for r in collected:
            if r.part == part:
                (lags if r.kind == "lag" else edges)[r.place] = r.products
        g = L.moments(lags, edges, width)
        picked = [i * width + f for i in range(n) for f in range(width - 1)] + [n * width]  # the window, and the next count
        count = g[width - 1, width - 1]
        if count:
            mean = g[width - 1, picked] / count
            out[part] = Moments(count, mean, g[np.ix_(picked, picked)] - count * np.outer(mean, mean))
    return out


def ridge(m: Moments, reg_param: float) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise ``mse / 2 + reg_param / 2 * |w|^2`` over the columns in units of their deviation."""
    variance = np.diag(m.centred) / m.n
    variance = np.where(variance <= FLAT * (variance + m.mean**2), 0.0, variance)
    live = np.flatnonzero(variance[:-1] > 0)
    scale, label = np.sqrt(variance[live]), np.sqrt(variance[-1])
    weights = np.zeros(len(variance) - 1)
    if label > 0 and len(live):
        a = m.centred[np.ix_(live, live)] / m.n / np.outer(scale, scale)
        b = m.centred[live, -1] / m.n / scale / label
        a[np.diag_indices_from(a)] += reg_param / label
        try:
            np.linalg.cholesky(a)
            solved = np.linalg.solve(a, b)
        except np.linalg.LinAlgError:  # columns that depend on each other: the smallest of all solutions
            solved = np.linalg.lstsq(a, b, rcond=None)[0]
        weights[live] = solved * label / scale
    return weights, float(m.mean[-1] - weights @ m.mean[:-1])


def fit_forecaster(spark: SparkSession, rows: DataFrame, reg_params=REG_PARAMS, n: int = C.N_STEPS):
    """Fit on the windows of indexed ``rows``.  Returns ``(results DataFrame, best LinearModel)``; without a
    training window no results and no model, without a validation window the first regularisation."""
    parts = part_moments(fit_sums(rows, n).collect(), n)
    train, valid = parts.get("train"), parts.get("valid")
    found, best, best_mse = [], None, None
    for rp in reg_params if train else ():
        weights, bias = ridge(train, rp)
        mse = valid.error(weights, bias) if valid else float("nan")
        found.append((f"linear_reg{rp}", float(rp), train.error(weights, bias), mse))
        if best is None or mse < best_mse:
            best_mse, best = mse, LinearModel(f"linear_reg{rp}", weights, bias, n)
    res = spark.createDataFrame(found, "model string, reg_param double, train_mse double, valid_mse double")
    return res.withColumn("selected", F.col("model") == F.lit(best.name if best else "")), best
