"""Many multinomial regressions at once: Newton steps whose sums are one pass over the rows for all models.

Models differ in the rows they leave out (a fold) and the columns they use.
Every pass puts each row next to the models that train on it, and sums up
slope and curvature per model in one aggregation with a partial one before the
shuffle; only those sums, a few numbers per model, reach the driver, where each
model takes its own step. A column that a model does not use is 0 in it, so all
models have one shape.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The curvature has this many rows and columns at most; larger models are fitted one by one by Spark's own learner.
MOST_WEIGHTS = 60
# Models next to a row at once; with weights as above they are a few megabytes.
MOST_MODELS = 10_000


@dataclass(frozen=True)
class Spec:
    """A model by name, trained on all rows outside ``fold``, or on all with None."""

    name: str
    fold: int | None
    columns: tuple[str, ...]


@dataclass
class Fitted:
    """Weights by class and column (the intercept last) of standardised values, and how they were reached."""

    spec: Spec
    labels: list
    columns: list[str]
    mean: np.ndarray
    scale: np.ndarray
    present: np.ndarray
    weights: np.ndarray
    passes: int = 0
    slope: float = float("inf")


def _moments(rows: DataFrame, fold: str, label: str, columns: list[str]) -> list:
    """Rows, means and squared deviations per fold and class: folds times classes rows."""
    return rows.groupBy(fold, label).agg(F.count("*").alias("n"), *[f for i, c in enumerate(columns) for f in (
        F.avg(c).alias(f"m{i}"), (F.var_pop(c) * F.count("*")).alias(f"s{i}"))]).collect()


def _start(spec: Spec, parts: list, fold: str, label: str, labels: list, columns: list[str]) -> Fitted:
    own = [r for r in parts if spec.fold is None or r[fold] != spec.fold]
    n = np.array([r["n"] for r in own], float)
    total = max(n.sum(), 1.0)
    means = np.array([[r[f"m{i}"] for i in range(len(columns))] for r in own]).reshape(len(own), len(columns))
    squares = np.array([[r[f"s{i}"] for i in range(len(columns))] for r in own]).reshape(len(own), len(columns))
    mean = (n[:, None] * means).sum(axis=0) / total
    var = (squares + n[:, None] * (means - mean) ** 2).sum(axis=0) / total
    scale = np.where(var > 0, np.sqrt(var), 1.0)
    used = np.array([c in spec.columns for c in columns])
    present = np.array([any(r[label] == y for r in own) for y in labels])
    return Fitted(spec, labels, columns, mean, np.where(used, scale, np.inf), present, np.zeros((len(labels), len(columns) + 1)))


def _table(rows: DataFrame, models: list[Fitted]) -> DataFrame:
    """A row per model: its number, fold, and flat columns of its numbers. As an Arrow table, it costs no job."""
    k, p = models[0].weights.shape
    return F.broadcast(rows.sparkSession.createDataFrame(pa.table({
        "__model": pa.array(range(len(models)), pa.int32()), "__fold": pa.array([m.spec.fold for m in models], pa.int32()),
        **{f"__m{j}": pa.array([float(m.mean[j]) for m in models], pa.float64()) for j in range(p - 1)},
        **{f"__s{j}": pa.array([float(1 / m.scale[j]) for m in models], pa.float64()) for j in range(p - 1)},
        **{f"__on{y}": pa.array([bool(m.present[y]) for m in models], pa.bool_()) for y in range(k)},
        **{f"__w{y}_{j}": pa.array([float(m.weights[y, j]) for m in models], pa.float64()) for y in range(k) for j in range(p)}})))


def _with_chances(rows: DataFrame, models: list[Fitted], on: str) -> DataFrame:
    """Rows next to models with ``__x<j>``, ``__l<y>`` (logits, null for a class without rows) and ``__p<y>``."""
    k, p = models[0].weights.shape
    logits = [" + ".join([*(f"__w{y}_{j} * __x{j}" for j in range(p - 1)), f"__w{y}_{p - 1}"]) for y in range(k)]
    return (rows.join(_table(rows, models), F.expr(on))
            .selectExpr("*", *[f"(__v{j} - __m{j}) * __s{j} AS __x{j}" for j in range(p - 1)])
            .selectExpr("*", *[f"CASE WHEN __on{y} THEN {logit} END AS __l{y}" for y, logit in enumerate(logits)])
            .selectExpr("*", f"greatest({', '.join(f'__l{y}' for y in range(k))}, CAST(NULL AS DOUBLE)) AS __top")
            .selectExpr("*", *[f"coalesce(exp(__l{y} - __top), 0D) AS __e{y}" for y in range(k)])
            .selectExpr("*", " + ".join(f"__e{y}" for y in range(k)) + " AS __all")
            .selectExpr("*", *[f"__e{y} / __all AS __p{y}" for y in range(k)]))


def _pass(rows: DataFrame, models: list[Fitted]) -> dict:
    """Per model ``(loss, slope, curvature)`` of the likelihood, without the penalty."""
    k, p = models[0].weights.shape
    met = _with_chances(rows, models, "__fold IS NULL OR __fold <> __part")
    x = [f" * __x{j}" for j in range(p - 1)] + [""]
    slopes = {(y, i): f"(__p{y} - CASE WHEN __y = {y} THEN 1D ELSE 0D END){x[i]}" for y in range(k) for i in range(p)}
    bends = {(y, i, u, j): f"__p{y} * ({int(y == u)}D - __p{u}){x[i]}{x[j]}"
             for y in range(k) for u in range(y, k) for i in range(p) for j in range(i, p)}
    own = " ".join(f"WHEN {y} THEN __l{y}" for y in range(k))
    loss = f"ln(__all) + __top - CASE __y {own} END"
    sums = met.groupBy("__model").agg(*[F.expr(f"sum({e}) AS t{i}") for i, e in enumerate(
        [loss, *slopes.values(), *bends.values()])]).collect()
    out = {}
    for r in sums:
        slope, bend = np.zeros((k, p)), np.zeros((k, p, k, p))
        for i, at in enumerate(slopes, 1):
            slope[at] = r[f"t{i}"]
        for i, (y, a, u, b) in enumerate(bends, 1 + len(slopes)):
            v = r[f"t{i}"]
            bend[y, a, u, b] = bend[y, b, u, a] = bend[u, a, y, b] = bend[u, b, y, a] = v
        out[r["__model"]] = (r["t0"], slope, bend.reshape(k * p, k * p))
    return out


def fit_many(rows: DataFrame, specs: list[Spec], *, label: str, columns: list[str], fold: str, c: float = 1.0,
             passes: int = 100, precise: float = 1e-10) -> list[Fitted]:
    """All models of ``specs``, penalised by ``1 / (2 c)`` times the squared weights without intercepts.

    Rows with a missing value train no model; a class that a model's rows do
    not have is never predicted by it. A model is done when no slope exceeds
    ``precise`` times its rows; if one is not after ``passes`` passes, that is
    an error. Steps that raise the loss are halved.
    """
    columns = list(columns)
    whole = rows.select(F.col(fold).alias(fold), F.col(label).alias(label), *[F.col(x).cast("double").alias(x) for x in columns]).na.drop(
        subset=[label, *columns])
    parts = _moments(whole, fold, label, columns)
    labels = sorted({r[label] for r in parts})
    if not labels:
        raise ValueError("no rows to learn from")
    if len(labels) * (len(columns) + 1) > MOST_WEIGHTS or len(specs) > MOST_MODELS:
        raise ValueError("too many weights or models for one pass")
    number = F.coalesce(*[F.when(F.col(label) == y, i) for i, y in enumerate(labels)])
    train = whole.select(F.col(fold).alias("__part"), number.alias("__y"), *[F.col(x).alias(f"__v{j}") for j, x in enumerate(columns)])
    models = [_start(s, parts, fold, label, labels, columns) for s in specs]
    n = [max(sum(r["n"] for r in parts if s.fold is None or r[fold] != s.fold), 1) for s in specs]
    k, p = models[0].weights.shape
    penal = np.tile(np.r_[np.full(p - 1, 1.0 / c), 0.0], k)
    kept: dict[int, tuple[float, np.ndarray]] = {}
    open_ = list(range(len(models)))
    for turn in range(1, passes + 1):
        found = _pass(train, [models[i] for i in open_])
        left = []
        for at, i in enumerate(open_):
            m = models[i]
            if at not in found:  # no rows
                m.slope = 0.0
                continue
            loss, slope, bend = found[at]
            w = m.weights.ravel()
            loss += 0.5 * float((penal * w * w).sum())
            slope = slope.ravel() + penal * w
            m.passes, m.slope = turn, float(np.abs(slope).max()) / n[i]
            if m.slope <= precise:
                continue
            if i in kept and loss > kept[i][0] * (1 + 1e-12) + 1e-12:
                m.weights = ((kept[i][1] + w) / 2).reshape(k, p)
            else:
                kept[i] = (loss, w)
                # Intercepts are free up to a common constant, hence the least-squares solution.
                step = np.linalg.lstsq(bend + np.diag(penal), slope, rcond=1e-13)[0]
                m.weights = (w - step).reshape(k, p)
                m.weights[:, :-1][:, np.isinf(m.scale)] = 0.0
            left.append(i)
        open_ = left
        if not open_:
            return models
    worst = max(models, key=lambda m: m.slope)
    raise RuntimeError(f"{worst.spec} has a slope of {worst.slope} after {passes} passes")


def coefficients(models: list[Fitted]) -> list[tuple]:
    """``(name, fold, label, column, weight)`` of the columns each model uses; of shifted intercepts the mean is 0."""
    out = []
    for m in models:
        shifted = m.weights[:, -1] - m.weights[m.present, -1].mean()
        for y, label in enumerate(m.labels):
            out += [(m.spec.name, m.spec.fold, label, c, float(m.weights[y, j])) for j, c in enumerate(m.columns) if c in m.spec.columns]
            out.append((m.spec.name, m.spec.fold, label, "intercept", float(shifted[y])))
    return out


def predict_folds(rows: DataFrame, models: list[Fitted], *, columns: list[str], fold: str, keep: list[str]) -> DataFrame:
    """``(keep.., model, fold, pred)``: every row by the models that left out its fold (all rows by those without one).

    The first label counts on a tie. A row with a missing value gets null.
    """
    k = len(models[0].labels)
    flat = rows.select(*keep, F.col(fold).alias("__part"), *[F.col(c).cast("double").alias(f"__v{j}") for j, c in enumerate(columns)])
    met = _with_chances(flat, models, "__fold IS NULL OR __fold = __part")
    pred = F.coalesce(*[F.when(F.col(f"__l{y}") == F.col("__top"), F.lit(models[0].labels[y])) for y in range(k)])
    missing = sum((F.col(f"__v{j}").isNull().cast("int") for j in range(len(columns))), F.lit(0)) > 0
    names = F.broadcast(rows.sparkSession.createDataFrame([(i, m.spec.name) for i, m in enumerate(models)], "__model int, model string"))
    return met.join(names, "__model").select(*keep, "model", F.col("__part").alias("fold"), F.when(~missing, pred).alias("pred"))
