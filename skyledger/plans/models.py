"""Classifiers, baselines and scoring (M1-M9) on MLlib; the deep perceptron is fitted in blocks (``operators.perceptron``)."""

from __future__ import annotations

import time

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import uniform_md5
from ..operators import metrics, perceptron
from ..session import discard, materialise, spread
from ..sources.experiment_log import log_run

# Model settings of the reference experiments.
LR_TUNED = {"elasticNetParam": 0.620118997676641, "regParam": 0.39387449470050384}
DT_PARAMS = {"maxDepth": 20, "maxBins": 10}
TREE_SEED = 456
MLP_HIDDEN = [64]
MLP_DEEP_HIDDEN = [128, 252, 128, 64]
MLP_PARAMS = {"maxIter": 100, "blockSize": 512, "seed": 523}


def classifier(kind: str, features: str, label: str, n_features: int | None = None, **params):
    """M1-M7: an unfitted MLlib estimator by short name."""
    common = {"featuresCol": features, "labelCol": label}
    if kind == "lr":
        return LogisticRegression(family="binomial", **common, **params)
    if kind == "lr_tuned":
        return LogisticRegression(family="binomial", **common, **{**LR_TUNED, **params})
    if kind == "dt":
        return DecisionTreeClassifier(**common, **{**DT_PARAMS, **params})
    if kind == "rf":
        return RandomForestClassifier(**common, **{"seed": TREE_SEED, **params})
    if kind == "gbt":
        return GBTClassifier(**common, **{"seed": TREE_SEED, **params})
    if kind in ("mlp", "mlp_deep"):
        if n_features is None:
            raise ValueError("n_features is required for the perceptron")
        hidden = MLP_HIDDEN if kind == "mlp" else MLP_DEEP_HIDDEN
        return MultilayerPerceptronClassifier(layers=[n_features, *hidden, 2], **common, **{**MLP_PARAMS, **params})
    raise ValueError(f"unknown classifier {kind!r}")


def vector_size(df: DataFrame, col: str) -> int:
    """Vector length from ML attribute metadata (no data scan); falls back to one row."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    if "attrs" in meta:
        return sum(len(v) for v in meta["attrs"].values())
    return len(df.select(col).head()[0])


def fit_classifier(kind: str, train: DataFrame, features: str, label: str, **params):
    n = vector_size(train, features) if kind.startswith("mlp") else None
    estimator = classifier(kind, features, label, n_features=n, **params)
    if kind == "mlp":                             # a hundred passes, each with one core per file
        train = spread(train.select(label, features))
    return perceptron.fit(estimator, train) if kind == "mlp_deep" else estimator.fit(train)


def baseline_predict(df: DataFrame, p_zero: float | Column, seed: int = 451, key: list[str] | None = None,
                     out: str = "prediction") -> DataFrame:
    """M8: predict 0.0 with probability ``p_zero``, else 1.0.

    With ``key`` the draw is an md5 of seed and key (repeatable on any
    partitioning); without it, ``rand(seed)``.
    """
    u = uniform_md5(seed, *key) if key else F.rand(seed)
    p = p_zero if isinstance(p_zero, Column) else F.lit(float(p_zero))
    return df.withColumn(out, F.when(u < p, F.lit(0.0)).otherwise(F.lit(1.0)))


def majority_share(df: DataFrame, label: str, positive=1.0) -> Column:
    """Share of non-positive rows as a scalar subquery (unrounded, see SURVEY Q2)."""
    return df.select(1.0 - F.count_if(F.col(label) == positive) / F.count(F.lit(1))).scalar()


def predict(model, df: DataFrame, keep: list[str] = (), prob_col: str = "probability") -> DataFrame:
    """M9: score ``df`` with a fitted model; probability of class 1 as a plain double."""
    scored = model.transform(df)
    cols = list(keep) + ["prediction"]
    if prob_col in scored.columns:
        return scored.select(*cols, vector_to_array(prob_col)[1].alias("p1"))
    return scored.select(*cols)


METRIC_NAMES = {"auc": "AUC", "accuracy": "accuracy", "weighted_precision": "precision", "weighted_recall": "recall",
                "weighted_f1": "f1", "balanced_accuracy": "balanced_accuracy"}


def score_all(fitted: dict, splits: dict[str, DataFrame], label: str) -> DataFrame:
    """``model, split, label, prediction, score`` of every model on every split: one scan of each split, written.

    The rows carry the label and one struct per model and are unfolded last,
    so features are read once however many models there are.
    """
    parts = []
    for split, df in splits.items():
        scored, outs = df, []
        for name, model in fitted.items():
            own = model.copy()
            cols = {c: f"__{name}_{c}" for c in ("prediction", "rawPrediction", "probability")}
            own.setPredictionCol(cols["prediction"])
            for c, setter in (("rawPrediction", "setRawPredictionCol"), ("probability", "setProbabilityCol")):
                if hasattr(own, setter):
                    getattr(own, setter)(cols[c])
            scored = own.transform(scored)
            p1 = vector_to_array(cols["probability"])[1] if cols["probability"] in scored.columns else F.col(cols["prediction"])
            outs.append(F.struct(F.lit(name).alias("model"), F.col(cols["prediction"]).alias("prediction"), p1.alias("score")))
        unfolded = scored.select(F.lit(split).alias("split"), F.col(label).cast("double").alias("label"), F.explode(F.array(*outs)).alias("m"))
        parts.append(unfolded.select("m.model", "split", "label", "m.prediction", "m.score"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return materialise(out)


def evaluate_all(fitted: dict, splits: dict[str, DataFrame], label: str) -> DataFrame:
    """E1-E4 of all models on all splits: one row per model, metric names prefixed by the split.

    One confusion table and one ordering of all scores serve every model and split.
    """
    by = ["model", "split"]
    scored = score_all(fitted, splits, label)
    found = (metrics.summary_from_confusion(materialise(metrics.confusion(scored, "prediction", "label", by)), by)
             .join(metrics.auc_by(scored, by, "score"), by))
    cells = [F.max(F.when(F.col("split") == s, F.col(c))).cast("double").alias(f"{s}_{n}") for s in splits for c, n in METRIC_NAMES.items()]
    out = materialise(found.groupBy("model").agg(*cells))
    discard(scored)
    return out


def logged_runs(kinds, train: DataFrame, test: DataFrame, features: str, label: str, log: str, dataset: str = "all") -> dict:
    """M1-M7 + E1-E4 + S7: fit all ``kinds``, score them together on both splits, log params, metrics and durations.

    Models are fitted one after the other, so each duration is its own. Returns the fitted models.
    """
    spark = train.sparkSession
    train = spread(train)                         # iterative fits use one core per file
    fitted, seconds = {}, {}
    for kind in kinds:
        began = time.monotonic()
        fitted[kind] = fit_classifier(kind, train, features, label)
        seconds[kind] = time.monotonic() - began
    table = evaluate_all(fitted, {"train": train, "test": test}, label)
    for kind, model in fitted.items():
        rid = log_run(spark, log, kind, {"dataset_name": dataset, "family": type(model).__name__}, {"Training Time (s)": seconds[kind]})
        log_run(spark, log, kind, {}, table.filter(F.col("model") == kind).drop("model"), run_id=rid)
    return fitted


def save_model(model, path: str) -> None:
    """Persist a fitted model or pipeline (overwrites)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a persisted pipeline model."""
    return PipelineModel.load(path)


__all__ = ["Pipeline", "classifier", "fit_classifier", "baseline_predict", "majority_share", "predict",
           "save_model", "load_model", "vector_size", "score_all", "evaluate_all", "logged_runs"]
