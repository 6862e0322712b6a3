"""Linear models of every kind from one Gram matrix.

One pass over the rows adds up all products of two columns (a one, the inputs, the label) for each split. From the train split's sums every
configuration is solved on the driver, where only the matrix is: least squares, ridge in closed form, non-negative least squares by
active sets, lasso and elastic net by coordinate descent. Squared errors on all splits follow from the same sums; absolute errors
take one more pass for all configurations together.

Categories enter as 0/1 inputs by a hash of their value, ``width`` of them for a column, so no vocabulary is gathered and the matrix has a
fixed largest size; with few values beside the width, two of them rarely share an input. Inputs that are constant get no weight.
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

SPLITS = ("train", "val", "test")
KINDS = ("LinearRegression", "Ridge", "Lasso", "ElasticNet")


@dataclass(frozen=True)
class Design:
    """Numeric columns and categories with the number of hashed inputs of each."""

    numeric: Sequence[str]
    categories: Mapping[str, int] = field(default_factory=dict)

    @property
    def starts(self) -> dict[str, int]:
        ends = list(itertools.accumulate(self.categories.values(), initial=1 + len(self.numeric)))
        return dict(zip(self.categories, ends))

    @property
    def size(self) -> int:
        """Columns of the matrix: a one, the inputs, the label."""
        return 2 + len(self.numeric) + sum(self.categories.values())

    def columns(self, label: str, *more: str) -> list:
        """The inputs as ``_x..`` and ``_c..`` (codes), the label as ``_y``; a missing number counts as 0."""
        codes = [F.pmod(F.xxhash64(F.lit(c), F.col(c)), F.lit(w)).cast("int").alias(f"_c{k}") for k, (c, w) in enumerate(self.categories.items())]
        numbers = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x{k}") for k, c in enumerate(self.numeric)]
        return [*numbers, *codes, F.col(label).cast("double").alias("_y"), *more]

    def numbers(self, rows: pd.DataFrame) -> np.ndarray:
        return rows[[f"_x{k}" for k in range(len(self.numeric))]].to_numpy(float)

    def codes(self, rows: pd.DataFrame) -> dict[str, np.ndarray]:
        return {c: rows[f"_c{k}"].to_numpy() for k, c in enumerate(self.categories)}


class _Sums:
    """Products of a split's columns, dense for numbers and by code for categories."""

    def __init__(self, design: Design):
        self.design, plain = design, len(design.numeric) + 2
        self.plain = np.zeros((plain, plain))
        self.mixed = {c: np.zeros((plain, w)) for c, w in design.categories.items()}
        self.pairs = {p: np.zeros([design.categories[c] for c in p]) for p in itertools.combinations(design.categories, 2)}

    def add(self, rows: pd.DataFrame) -> None:
        x = np.column_stack([np.ones(len(rows)), self.design.numbers(rows), rows["_y"].to_numpy(float)])
        self.plain += x.T @ x
        codes = self.design.codes(rows)
        for c, w in self.design.categories.items():
            for i in range(x.shape[1]):
                self.mixed[c][i] += np.bincount(codes[c], x[:, i], w)
        for a, b in self.pairs:
            w = self.design.categories[b]
            self.pairs[a, b] += np.bincount(codes[a].astype(np.int64) * w + codes[b], minlength=self.pairs[a, b].size).reshape(-1, w)

    def cells(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, sum) of the upper triangle, zeros left out."""
        last, starts = self.design.size - 1, self.design.starts
        place = np.append(np.arange(len(self.plain) - 1), last)

        def filled(table: np.ndarray, rows: np.ndarray, columns: np.ndarray):
            i, j = np.nonzero(table)
            return np.minimum(rows[i], columns[j]), np.maximum(rows[i], columns[j]), table[i, j]

        yield filled(np.triu(self.plain), place, place)
        for c, table in self.mixed.items():
            yield filled(table, place, starts[c] + np.arange(table.shape[1]))
            yield filled(np.diag(table[0]), starts[c] + np.arange(table.shape[1]), starts[c] + np.arange(table.shape[1]))
        for (a, b), table in self.pairs.items():
            yield filled(table, starts[a] + np.arange(table.shape[0]), starts[b] + np.arange(table.shape[1]))


def gram(data: DataFrame, design: Design, label: str = "label") -> DataFrame:
    """split, i, j, v: sums of products of columns i <= j, one row for each that is not zero."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, _Sums] = {}
        for batch in batches:
            for split, rows in batch.groupby("split"):
                sums.setdefault(split, _Sums(design)).add(rows)
        for split, own in sums.items():
            for i, j, v in own.cells():
                yield pd.DataFrame({"split": split, "i": i, "j": j, "v": v})

    parts = data.where(F.col(label).isNotNull()).select(*design.columns(label, "split")).mapInPandas(add, "split string, i int, j int, v double")
    return parts.groupBy("split", "i", "j").agg(F.sum("v").alias("v"))


def matrices(data: DataFrame, design: Design, label: str = "label") -> dict[str, np.ndarray]:
    """The whole matrix of each split; its size is fixed by the design."""
    table = gram(data, design, label).toPandas()
    out = {}
    for split, rows in table.groupby("split"):
        m = np.zeros((design.size, design.size))
        m[rows["i"], rows["j"]] = rows["v"]
        out[split] = m + np.triu(m, 1).T
    return out


@dataclass
class LinearModel:
    intercept: float
    weights: np.ndarray

    def errors(self, m: np.ndarray) -> tuple[float, float]:
        """RMSE and R2 on the rows of a matrix."""
        w = np.concatenate([[self.intercept], self.weights, [-1.0]])
        n, squares = m[0, 0], max(float(w @ m @ w), 0.0)
        total = m[-1, -1] - m[0, -1] ** 2 / n
        return float((squares / n) ** 0.5), float(1 - squares / total) if total > 0 else None


def least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solution of the normal equations with the least norm of the scaled weights; collinear inputs share theirs."""
    scale = np.sqrt(np.diag(a))
    values, vectors = np.linalg.eigh(a / np.outer(scale, scale))
    kept = values > values[-1] * len(a) * 1e-13 if len(a) else []
    return (vectors[:, kept] / values[kept]) @ (vectors[:, kept].T @ (b / scale)) / scale


def non_negative(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least squares with no weight below zero: inputs enter by the steepest gradient and leave where they would turn negative."""
    w, held = np.zeros(len(b)), np.zeros(len(b), bool)
    floor = 1e-12 * np.abs(b).max(initial=0.0)
    for _ in range(30 * len(b) + 30):
        slope = np.where(held, -np.inf, b - a @ w)
        if not len(b) or slope.max() <= floor:
            break
        held[slope.argmax()] = True
        while True:
            trial = np.zeros(len(b))
            trial[held] = least_squares(a[np.ix_(held, held)], b[held])
            low = held & (trial <= 0)
            if not low.any():
                w = trial
                break
            step = (w[low] / np.maximum(w[low] - trial[low], 1e-300)).min()
            w = w + step * (trial - w)
            gone = held & (w <= 1e-15 * np.abs(w).max(initial=1.0))
            held, w = held & ~gone, np.where(gone, 0.0, w)
    return w


def descent(a: np.ndarray, b: np.ndarray, l1: float, l2: float, sweeps: int, tolerance: float = 1e-12) -> np.ndarray:
    """Coordinate descent on w'aw / 2 - b'w + l1 |w| + l2 w'w / 2."""
    w, diagonal = np.zeros(len(b)), np.diag(a)
    rest = b.copy()  # b - a w
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(b)):
            pull = rest[j] + diagonal[j] * w[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (diagonal[j] + l2)
            if new != w[j]:
                rest -= a[j] * (new - w[j])
                moved = max(moved, abs(new - w[j]) * diagonal[j] ** 0.5)
                w[j] = new
        if moved <= tolerance * (1 + np.abs(w * diagonal**0.5).max(initial=0.0)):
            break
    return w


def solve(m: np.ndarray, kind: str, params: Mapping) -> LinearModel:
    """The model of a train matrix. Penalties as in ``learn.models.regressor``; the intercept has none."""
    n, inside = m[0, 0], slice(1, -1)
    a, b, means, middle = m[inside, inside], m[inside, -1], m[0, inside] / n, m[0, -1] / n
    spread = np.diag(a) - n * means**2 > 1e-11 * np.maximum(np.diag(a), 1e-300)
    if params.get("fit_intercept", True):
        a, b = a - n * np.outer(means, means), b - n * means * middle
        used = spread
    else:
        used = np.diag(a) > 0
    a, b = a[np.ix_(used, used)], b[used]
    alpha, l1 = params.get("alpha", 0.0), params.get("l1_ratio", 1.0)
    if kind == "Ridge":
        w = np.linalg.solve(a + alpha * np.eye(len(b)), b)
    elif kind in ("Lasso", "ElasticNet"):
        w = descent(a, b, n * alpha * l1, n * alpha * (1 - l1), params.get("max_iter", 1000))
    elif kind == "LinearRegression":
        w = non_negative(a, b) if params.get("positive") else least_squares(a, b)
    else:
        raise ValueError(f"no linear model {kind}")
    weights = np.zeros(len(means))
    weights[used] = w
    return LinearModel(float(middle - means @ weights) if params.get("fit_intercept", True) else 0.0, weights)


def _predicted(rows: pd.DataFrame, design: Design, models: Sequence[LinearModel]) -> np.ndarray:
    weights = np.stack([np.concatenate([[m.intercept], m.weights]) for m in models], 1)
    out = weights[0] + design.numbers(rows) @ weights[1 : 1 + len(design.numeric)]
    for c, code in design.codes(rows).items():
        out += weights[design.starts[c] + code]
    return out


def predictions(data: DataFrame, design: Design, models: Mapping[str, LinearModel], keep: Sequence[str], label: str = "label") -> DataFrame:
    """``keep`` (with the label under its name) and a prediction column for each model, in one pass."""
    held = [c for c in keep if c != label]
    kinds = dict(data.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in held], f"`{label}` double", *[f"`{c}` double" for c in models]])
    own = [F.col(c).alias(f"_keep_{c}") for c in held]

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = pd.DataFrame({c: rows[f"_keep_{c}"] for c in held})
            out[label] = rows["_y"]
            yield pd.concat([out, pd.DataFrame(_predicted(rows, design, list(models.values())), columns=list(models), index=rows.index)], axis=1)

    return data.select(*design.columns(label), *own).mapInPandas(predict, schema)


def absolute_errors(data: DataFrame, design: Design, models: Sequence[LinearModel], label: str = "label") -> dict[str, np.ndarray]:
    """Mean absolute error of each model on each split, in one pass."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for split, rows in batch.groupby("split"):
                wrong = np.abs(_predicted(rows, design, models) - rows["_y"].to_numpy()[:, None]).sum(0)
                sums[split] = sums.get(split, 0.0) + np.append(wrong, len(rows))
        for split, v in sums.items():
            yield pd.DataFrame({"split": split, "model": range(len(v)), "v": v})

    rows = data.where(F.col(label).isNotNull()).select(*design.columns(label, "split"))
    table = rows.mapInPandas(add, "split string, model int, v double").groupBy("split", "model").agg(F.sum("v").alias("v")).toPandas()
    out = {s: t.sort_values("model")["v"].to_numpy() for s, t in table.groupby("split")}
    return {s: v[:-1] / v[-1] for s, v in out.items()}


def linear_grid(data: DataFrame, design: Design, grid: Mapping[str, Mapping[str, list]], label: str = "label") -> list[dict]:
    """Rows of the run table for all configurations of linear kinds, with the fitted ``model`` in each: two passes over ``data``."""
    from salescope.learn.models import combinations, run_name

    at = matrices(data, design, label)
    rows = []
    for kind, options in grid.items():
        for number, params in enumerate(combinations(options), 1):
            start = time.perf_counter()
            model = solve(at["train"], kind, params)
            rows.append({"model_name": kind, "config_num": number, "run_name": run_name(kind, params), "model": model,
                         "training_time": time.perf_counter() - start, "params": {k: str(v) for k, v in params.items()}})
    wrong = absolute_errors(data, design, [r["model"] for r in rows], label)
    for k, row in enumerate(rows):
        for split in SPLITS:
            rmse, r2 = row["model"].errors(at[split]) if split in at else (None, None)
            row.update({f"{split}_rmse": rmse, f"{split}_r2": r2, f"{split}_mae": float(wrong[split][k]) if split in wrong else None})
    return rows


def typed(params: Mapping[str, str]) -> dict:
    """Parameters of a stored run as numbers and truth values."""
    named = {"True": True, "False": False}
    return {k: named[v] if v in named else int(v) if v.lstrip("-").isdigit() else float(v) for k, v in params.items()}


def export(spark, data: DataFrame, design: Design, kind: str, params: Mapping[str, str], path: str, label: str, name: str,
           fitted_on: Sequence[str] = ("train", "val")) -> str:
    """Fit a stored configuration on several splits together and write it as JSON with its inputs and test errors; returns ``path``.

    The splits' matrices add up, so the fit reads the rows once and the absolute error once more.
    """
    from salescope.sources.files import save_json

    at = matrices(data, design, label)
    model = solve(sum(at[s] for s in fitted_on if s in at), kind, typed(params))
    rmse, r2 = model.errors(at["test"])
    mae = float(absolute_errors(data.where(F.col("split") == "test"), design, [model], label)["test"][0])
    schema = ("run_name string, model_name string, params map<string,string>, label string, numeric array<string>, categories map<string,int>, "
              "fitted_on array<string>, intercept double, weights array<double>, test struct<test_rmse:double,test_mae:double,test_r2:double>")
    row = (name, kind, dict(params), label, list(design.numeric), dict(design.categories), list(fitted_on), model.intercept,
           [float(w) for w in model.weights], (rmse, mae, r2))
    save_json(spark.createDataFrame([row], schema), path)
    return path
