"""Class-balanced logistic models on MLlib.

Penalty mapping: scikit-learn minimises C * sum(w l) + |b|^2 / 2; MLlib
minimises sum(w l) / sum(w) + regParam |b|^2 / 2. With balanced weights
sum(w) = n, so regParam = 1 / (C n), no elastic net, no standardisation.
Scaling uses the population standard deviation (trap 12) and lives inside
the saved pipeline as a SQL stage, so a loaded bundle scores identically.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WEIGHT = "__w"


@dataclass
class Candidate:
    name: str
    c_value: float
    scaled: bool
    max_iter: int


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Weight n / (2 n_c) per class (one row per class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    n = F.sum("__nc").over(Window.partitionBy())     # over the per-class table (2 rows)
    return counts.select(label, (n / (F.lit(2.0) * F.col("__nc"))).alias(WEIGHT))


def with_class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    # At most two rows (labels are 0/1): a bounded broadcast.
    return df.join(F.broadcast(class_weights(df, label)), label)


def population_scaler(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column (one aggregate, 2k numbers)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    r = df.agg(*aggs).first()
    out = {}
    for c in cols:
        s = r[f"s_{c}"] or 0.0
        out[c] = (float(r[f"m_{c}"] or 0.0), float(s) if s > 0 else 1.0)   # zero variance -> scale 1
    return out


def scaler_stage(scaler: dict[str, tuple[float, float]]) -> SQLTransformer:
    exprs = ", ".join(f"(CAST(`{c}` AS DOUBLE) - {m!r}) / {s!r} AS `{c}__z`" for c, (m, s) in scaler.items())
    return SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__")


@dataclass
class TrainSummary:
    """What a fit needs to know of its rows, from one aggregate: G13 and G14."""
    n: int
    n_positive: int
    scaler: dict[str, tuple[float, float]]

    def weight(self, label: str = "label"):
        """n / (2 n_c) of the row's class."""
        pos, neg = max(self.n_positive, 1), max(self.n - self.n_positive, 1)
        return F.when(F.col(label) == 1, F.lit(self.n / (2.0 * pos))).otherwise(F.lit(self.n / (2.0 * neg)))

    @property
    def classes(self) -> int:
        return (self.n_positive > 0) + (self.n_positive < self.n)


def train_summary(train: DataFrame, features: Sequence[str], label: str = "label") -> TrainSummary:
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("p")]
    for c in features:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    r = train.agg(*aggs).first()
    return TrainSummary(r["n"], r["p"], {c: (float(r[f"m_{c}"] or 0.0), float(r[f"s_{c}"] or 0.0) or 1.0) for c in features})


def fit_logistic(train: DataFrame, features: Sequence[str], label: str = "label",
                 c_value: float = 1.0, max_iter: int = 1000, balanced: bool = True,
                 scaled: bool = False, tol: float = 1e-10, summary: TrainSummary | None = None) -> PipelineModel:
    """M1 / one M2 candidate. Returns a PipelineModel that adds ``probability``.
    One aggregate (``summary``, shared by several fits on the same rows) gives the class
    weights, their sum and the scaler."""
    summary = summary or train_summary(train, features, label)
    data = train.withColumn(WEIGHT, summary.weight(label) if balanced else F.lit(1.0))
    n = summary.n * summary.classes / 2 if balanced else summary.n
    stages = []
    inputs = list(features)
    if scaled:
        stages.append(scaler_stage(summary.scaler))
        inputs = [f"{c}__z" for c in features]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
    stages.append(LogisticRegression(featuresCol="features", labelCol=label, weightCol=WEIGHT,
                                     regParam=1.0 / (float(c_value) * float(n)), elasticNetParam=0.0,
                                     standardization=False, fitIntercept=True, maxIter=int(max_iter),
                                     tol=tol, family="binomial"))
    return Pipeline(stages=stages).fit(data.withColumn(label, F.col(label).cast("double")))


#: A Newton step below this, in units of one standard deviation, is the last: what is left
#: after it is of the order of its square.
LAST_STEP = 1e-5
#: Rows of a block, summed at once within a task.
STEP_ROWS = 1 << 11


def _blocks(rows: DataFrame, center: np.ndarray, scale: np.ndarray) -> DataFrame:
    """Standardised inputs and label (the last column) of up to STEP_ROWS rows a block, column
    by column as doubles: read by every pass, so that none turns rows into columns again."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
            if np.isnan(x).any() or not np.isin(x[-1], (0, 1)).all():
                raise ValueError("fit rejected: a null or NaN input, or a label other than 0 and 1")
            x[:-1] -= center[:, None]
            x[:-1] /= scale[:, None]
            for i in range(0, b.num_rows, STEP_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array([x[:, i:i + STEP_ROWS].tobytes()], pa.binary())], names=["block"])

    return rows.mapInArrow(pack, "block binary")


def _step_sums(blocks: DataFrame, at: np.ndarray, weights: tuple[float, float]) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """Per row of ``at`` (intercept and coefficients of the standardised inputs): the weighted
    log loss, its gradient and its second derivatives, all from one pass."""
    k = at.shape[1]
    left, right = np.triu_indices(k)        # the second derivatives are symmetric

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient, second = np.zeros(len(at)), np.zeros((len(at), k)), np.zeros((len(at), len(left)))
        for block in (block for b in batches for block in b.column(0)):
            *x, y = np.frombuffer(block.as_buffer()).reshape(k, -1)
            x, w = np.stack([np.ones(len(y)), *x]), np.where(y == 1, *weights)
            margin = at @ x
            e = np.exp(-np.abs(margin))
            p = np.where(margin < 0, e, 1) / (1 + e)
            loss += (np.maximum(margin, 0) + np.log1p(e) - y * margin) @ w
            gradient += (w * (p - y)) @ x.T
            p *= 1 - p
            p *= w
            second += p @ (x[left] * x[right]).T
        total = np.column_stack([loss, gradient, second]).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total)], names=["place", "value"])

    found = blocks.mapInArrow(sums, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((len(at), 1 + k + len(left)))
    for r in found:
        total.ravel()[r["place"]] = r["value"]
    out = []
    for t in total:
        second = np.zeros((k, k))
        second[left, right] = second[right, left] = t[k + 1:]
        out.append((t[0], t[1:k + 1], second))
    return out


def _newton(blocks: DataFrame, penalties: np.ndarray, max_iter: Sequence[int], weights: tuple[float, float], n: float) -> np.ndarray:
    """Damped Newton steps for all fits at once, one pass over the rows a step: per row of
    ``penalties`` the intercept and coefficients where (weighted log loss) / n + sum(penalty b^2) / 2
    is smallest. A step that does not lower this is halved."""
    at = np.zeros((len(penalties), penalties.shape[1] + 1))
    best: list = [None] * len(at)           # objective, coefficients and step where it was lowest
    left = [i for i in range(len(at)) if max_iter[i] > 0]
    taken = 0
    while left:
        sums = _step_sums(blocks, at[left], weights)
        taken += 1
        going = []
        for i, (loss, gradient, second) in zip(left, sums, strict=True):
            ridge = np.append(0.0, penalties[i])
            value = loss / n + ridge @ at[i] ** 2 / 2
            if not np.isfinite(value):
                raise ValueError("fit rejected: its inputs or their spread are not finite")
            if best[i] is not None and value > best[i][0] + 1e-12 * abs(best[i][0]):
                step = best[i][2] / 2
                best[i] = (*best[i][:2], step)
            else:
                step = -np.linalg.lstsq(second / n + np.diag(ridge), gradient / n + ridge * at[i])[0]
                best[i] = (value, at[i].copy(), step)
            at[i] = best[i][1] + step
            if np.abs(step).max() > LAST_STEP and taken < max_iter[i]:
                going.append(i)
        left = going
    return at


def fit_candidates(train: DataFrame, features: Sequence[str], candidates: Sequence[Candidate], label: str = "label",
                   summary: TrainSummary | None = None) -> list[PipelineModel]:
    """M2: all candidates in the same passes, about six in all, over one cached table of blocks of
    standardised rows; a candidate on raw inputs has its penalty, and gets its coefficients, in
    their units. Same models as ``fit_logistic``, in the given order."""
    summary = summary or train_summary(train, features, label)
    n = summary.n * summary.classes / 2
    center, scale = (np.array(v) for v in zip(*(summary.scaler[c] for c in features), strict=True))
    penalties = np.array([np.full(len(features), 1.0 / (float(c.c_value) * n)) / (1.0 if c.scaled else scale ** 2) for c in candidates])
    rows = train.select(*(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)), F.col(label).cast("double").alias("y"))
    blocks = _blocks(rows, center, scale).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if summary.classes == 2:
            found = _newton(blocks, penalties, [int(c.max_iter) for c in candidates],
                            (summary.n / (2.0 * summary.n_positive), summary.n / (2.0 * (summary.n - summary.n_positive))), n)
        else:                               # one class: certain whatever the inputs, which must be sound
            blocks.count()
            found = np.zeros((len(candidates), len(features) + 1))
            found[:, 0] = np.inf if summary.n_positive else -np.inf
    finally:
        blocks.unpersist()
    models = []
    for c, own in zip(candidates, found, strict=True):
        b = own[1:] if c.scaled else own[1:] / scale
        inputs = [f"{f}__z" for f in features] if c.scaled else list(features)
        models.append(PipelineModel([*([scaler_stage(summary.scaler)] if c.scaled else []),
                                     VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"),
                                     logistic_model(b, own[0] if c.scaled else own[0] - b @ center)]))
    return models


def logistic_model(coefficients: Sequence[float], intercept: float) -> LogisticRegressionModel:
    """MLlib's model with the given numbers, as a fit would return it, without a training summary."""
    uid = LogisticRegression().uid
    made = LogisticRegressionModel(LogisticRegression._new_java_obj(
        "org.apache.spark.ml.classification.LogisticRegressionModel", uid, Vectors.dense(coefficients), float(intercept)))
    return made.setFeaturesCol("features")


def probability(model: PipelineModel, df: DataFrame) -> tuple[DataFrame, Column]:
    """(rows with the model's inputs, probability of class 1). A logistic model is applied as a
    column expression over its inputs: no vectors, no function calls out of generated code, and
    no model object in the plan (a fitted one drags its training summary, and so the session,
    into every task). A scorecard's last stage gives the number itself."""
    *stages, last = model.stages
    if not hasattr(last, "coefficients"):
        return model.transform(df), F.col("probability")
    *stages, assembler = stages
    for stage in stages:
        df = stage.transform(df)
    margin = F.lit(float(last.intercept))
    for w, c in zip(last.coefficients.toArray(), assembler.getInputCols(), strict=True):
        margin = margin + F.lit(float(w)) * F.col(c).cast("double")
    return df, F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def score(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    """M3: probability of class 1 as a double column; other columns kept. A null or NaN input
    gives a score that every score operator refuses."""
    cols = df.columns
    t, p = probability(model, df)
    return t.select(*cols, p.alias(out))


def gradient_check(model: PipelineModel, train: DataFrame, label: str = "label",
                   c_value: float = 1.0, balanced: bool = True) -> DataFrame:
    """Optimality of a fit for the scikit-learn objective: the gradient of
    sum(w l) / n + |b|^2 / (2 C n) at the fitted coefficients, per
    coordinate, from one aggregate. Returns max_abs_gradient."""
    lr = model.stages[-1]
    coef = [float(x) for x in lr.coefficients.toArray()]
    data = with_class_weights(train, label) if balanced else train.withColumn(WEIGHT, F.lit(1.0))
    t, p = probability(model, data.withColumn(label, F.col(label).cast("double")))
    x = [F.col(c).cast("double") for c in model.stages[-2].getInputCols()]
    r = F.col(WEIGHT) * (p - F.col(label))
    aggs = [F.sum(r).alias("g0"), F.sum(WEIGHT).alias("n")]
    aggs += [F.sum(r * x[j]).alias(f"g{j + 1}") for j in range(len(coef))]
    aggs += [F.stddev_pop(x[j]).alias(f"s{j + 1}") for j in range(len(coef))]
    row = t.agg(*aggs).first()
    n = float(row["n"])
    grads = [row["g0"] / n] + [row[f"g{j + 1}"] / n + coef[j] / (c_value * n) for j in range(len(coef))]
    # The same gradient in standardised coordinates (coefficient x std), the
    # space MLlib optimises in whatever ``standardization`` says: d/dgamma_j =
    # g_j / std_j. It makes the check independent of feature units.
    stds = [1.0] + [float(row[f"s{j + 1}"] or 0.0) or 1.0 for j in range(len(coef))]
    scaled = [g / sd for g, sd in zip(grads, stds)]
    spark = train.sparkSession
    return spark.range(1).select(F.lit(max(abs(g) for g in grads)).alias("max_abs_gradient"),
                                 F.lit(max(abs(g) for g in scaled)).alias("max_abs_scaled_gradient"))


# ---------------------------------------------------------------- bundle S7/S8

def save_bundle(model: PipelineModel, features: Sequence[str], target_fpr: float,
                threshold: float, path: str) -> None:
    """The pipeline plus a one-row metadata table."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    meta = spark.createDataFrame(
        [(json.dumps(list(features)), float(target_fpr), float(threshold))],
        "feature_columns string, target_fpr double, threshold_for_target_fpr double")
    meta.write.mode("overwrite").parquet(f"{path}/meta")


@dataclass
class Bundle:
    model: PipelineModel
    feature_columns: list[str] | None
    decline_threshold: float | None
    target_fpr: float | None


def _meta_row(spark: SparkSession, path: str):
    """The metadata row of a bundle, or None where it has none."""
    try:
        rows = spark.read.parquet(f"{path}/meta").limit(1).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows[0] if rows else None


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """A bundle, or a bare saved pipeline without metadata; rejects a model that gives no
    probability and a feature entry that is no list."""
    meta = _meta_row(spark, path)
    model = PipelineModel.load(f"{path}/model" if meta is not None else path)
    last = model.stages[-1] if model.stages else None
    if not (hasattr(last, "coefficients") or isinstance(last, SQLTransformer) and " AS probability " in last.getStatement()):
        raise ValueError("bundle rejected: its last stage gives no probability")
    if meta is None:
        return Bundle(model, None, None, None)
    feats = json.loads(meta["feature_columns"]) if meta["feature_columns"] else None
    if feats is not None and not isinstance(feats, list):
        raise ValueError("bundle rejected: feature_columns is not a list")
    return Bundle(model, feats, meta["threshold_for_target_fpr"], meta["target_fpr"])


def default_candidates(c_values: Sequence[float] = (0.1, 0.3, 1.0, 3.0), max_iter: int = 2000) -> list[Candidate]:
    """M2: one raw C=1.0 model, then one scaled model per C."""
    out = [Candidate("raw_logreg_c1.0", 1.0, False, max_iter)]
    out += [Candidate(f"scaled_logreg_c{c}", float(c), True, max_iter) for c in c_values]
    return out
