"""From one Gold cohort to a gated, saved risk model."""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.features import bounded, synthetic_income
from ledgerlark.operators.boosting import BoostedTrees, fit_boosted_trees
from ledgerlark.operators.psi import long_form
from ledgerlark.operators.quantiles import exact_quantiles
from ledgerlark.operators.ranking import model_metrics
from ledgerlark.operators.split import stratified_split
from ledgerlark.plans.gold import day
from ledgerlark.plans.tracking import run_rows, track
from ledgerlark.schemas import FEATURES
from ledgerlark.session import scratch_scope, written
from ledgerlark.sources.lake import Lake, path_exists

log = logging.getLogger(__name__)

LABEL = "target_default_30d"
# Fixed values of the training set.
TEST_SHARE = 0.3
MIN_ROWS = 10

# Fixed values of the acceptance gate.
MIN_GINI = 0.65
MIN_KS = 0.45

# Fixed values of the boosted-tree fit.
MODEL_PARAMS = {
    "maxIter": 100,
    "maxDepth": 5,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    # Two of the three features, drawn for each node.
    "featureSubsetStrategy": "2",
}
# The same fit by second-order splits, with its own draw of columns for each tree.
SECOND_ORDER_PARAMS = {"trees": 100, "depth": 5, "step": 0.05, "row_share": 0.8, "column_share": 0.8}

Model = PipelineModel | BoostedTrees


class ModelRejected(Exception):
    """The model does not meet the acceptance gate."""


def with_income(rows: DataFrame, seed: int = 42) -> DataFrame:
    return rows.withColumn(
        "income", synthetic_income(F.col("monthly_volume"), F.col("user_id"), seed)
    )


def training_rows(
    gold: DataFrame, observation_date: str | dt.date, seed: int = 42
) -> DataFrame:
    """One cohort with its income; the date is compared as a date, so partitions prune."""
    cohort = gold.where(F.col("observation_date") == day(observation_date))
    return with_income(
        cohort.select("user_id", "monthly_volume", "session_regularity", LABEL), seed
    )


def check_trainable(rows: DataFrame) -> None:
    """Raise unless there are at least 10 rows of both classes."""
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(LABEL) == 1).alias("positives"),
        F.count_if(F.col(LABEL) == 0).alias("negatives"),
    ).first()
    if found["n"] == 0:
        raise ValueError("no data for this observation date")
    if found["n"] < MIN_ROWS:
        raise ValueError(f"at least {MIN_ROWS} records are needed to train")
    if not (found["positives"] and found["negatives"]):
        raise ValueError("both classes are needed to train")


def split_rows(rows: DataFrame, test_size: float = TEST_SHARE, seed: int = 42) -> DataFrame:
    """Bounded features and the ``is_test`` flag."""
    kept = [c for c in rows.columns if c not in FEATURES]
    bounds = rows.select(*kept, *[bounded(f) for f in FEATURES])
    return stratified_split(bounds, "user_id", LABEL, test_size, seed)


def impute(split: DataFrame) -> DataFrame:
    """Fill missing features of both parts with the medians of the training part."""
    medians = exact_quantiles(
        long_form(split.where(~F.col("is_test")), list(FEATURES)), "value", [0.5], "variable"
    )
    one_row = medians.agg(
        F.struct(
            *[
                F.coalesce(
                    F.max(F.when(F.col("variable") == f, F.col("quantiles")[0])), F.lit(0.0)
                ).alias(f)
                for f in FEATURES
            ]
        ).alias("m")
    )
    filled = split.select("*", one_row.scalar().alias("_m"))
    return filled.select(
        *[
            F.coalesce(F.col(c), F.col("_m")[c]).alias(c) if c in FEATURES else F.col(c)
            for c in split.columns
        ]
    )


def class_weight(train: DataFrame) -> DataFrame:
    """One row: negatives per positive of the training part, 1.0 without positives."""
    positives, negatives = F.count_if(F.col(LABEL) == 1), F.count_if(F.col(LABEL) == 0)
    return train.agg(
        F.when(positives > 0, negatives / positives).otherwise(F.lit(1.0)).alias("class_weight")
    )


def fit(train: DataFrame, seed: int = 42, label: str = LABEL, **params) -> PipelineModel:
    """Boosted trees over the features, positives weighted up to balance the classes.

    Long lineages are cut every ten trees where the caller's context has a checkpoint folder.
    """
    weight = class_weight(train.withColumn(LABEL, F.col(label))).scalar()
    weighted = train.withColumn("_w", F.when(F.col(label) == 1, weight).otherwise(F.lit(1.0)))
    trees = GBTClassifier(
        featuresCol="features",
        labelCol=label,
        weightCol="_w",
        seed=seed,
        checkpointInterval=10,
        **{**MODEL_PARAMS, **params},
    )
    assemble = VectorAssembler(
        inputCols=list(FEATURES), outputCol="features", handleInvalid="keep"
    )
    rows = weighted.select(*FEATURES, F.col(label).cast("double").alias(label), "_w")
    # Every level of every tree reads all rows: they are dealt over the cores, else a few files are a few tasks.
    rows = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)
    return Pipeline(stages=[assemble, trees]).fit(written(rows, "train"))


def fit_second_order(
    train: DataFrame, seed: int = 42, label: str = LABEL, key: str = "user_id", **params
) -> BoostedTrees:
    """The learner with gradient and hessian sums; positives are weighted up as in ``fit``."""
    weight = class_weight(train.withColumn(LABEL, F.col(label))).scalar()
    weighted = train.withColumn("_weight", F.when(F.col(label) == 1, weight).otherwise(F.lit(1.0)))
    spent = {**SECOND_ORDER_PARAMS, **params}
    return fit_boosted_trees(weighted, FEATURES, label, key, F.col("_weight"), seed=seed, **spent)


#: How a model is fitted, and its fixed parameters.
LEARNERS = {"gbt": (fit, MODEL_PARAMS), "second_order": (fit_second_order, SECOND_ORDER_PARAMS)}


def predict(model: Model, rows: DataFrame) -> DataFrame:
    """Add ``probability_of_default`` and the hard ``prediction``; NULL features give NULL."""
    complete = F.lit(True)
    for f in FEATURES:
        complete = complete & F.col(f).isNotNull()
    if isinstance(model, BoostedTrees):
        pd = F.col("probability_of_default")
        scored = model.with_probability(rows, "probability_of_default")
        scored = scored.withColumn("probability_of_default", F.when(complete, pd))
        return scored.withColumn("prediction", (pd > 0.5).cast("double"))
    return (
        model.transform(rows)
        .withColumn(
            "probability_of_default", F.when(complete, vector_to_array("probability")[1])
        )
        .drop("features", "rawPrediction", "probability")
    )


def gate(metrics: dict[str, float]) -> None:
    gini, ks = metrics["gini_index"], metrics["ks_statistic"]
    if gini is None or gini < MIN_GINI or ks < MIN_KS:
        raise ModelRejected(
            f"Gini {gini} and KS {ks} are below the gate of {MIN_GINI} and {MIN_KS}"
        )


def save_model(model: Model, path: str, spark: SparkSession | None = None) -> None:
    """A table of trees for second-order models, else Spark's own form."""
    if isinstance(model, BoostedTrees):
        model.save(spark or SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> Model:
    spark = SparkSession.active()
    return PipelineModel.load(path) if path_exists(spark, f"{path}/metadata") else BoostedTrees.load(spark, path)


def load_model_if_any(spark: SparkSession, path: str) -> Model | None:
    """The model, or None where there is none: scoring then answers with the fallback."""
    if path_exists(spark, path):
        return load_model(path)
    log.warning("no model at %s, scoring will fall back", path)
    return None


def train_pipeline(
    lake: Lake,
    observation_date: str | dt.date,
    model_path: str,
    seed: int = 42,
    run_id: str | None = None,
    learner: str = "gbt",
    **params,
) -> dict[str, float]:
    """Train on one cohort; save and track the model only if it passes the gate."""
    with scratch_scope(lake.spark):
        return _train(lake, observation_date, model_path, seed, run_id, learner, params)


def _train(lake, observation_date, model_path, seed, run_id, learner, params) -> dict[str, float]:
    fit_model, fixed = LEARNERS[learner]
    rows = written(
        training_rows(lake.read("gold", "target_construction"), observation_date, seed), "cohort"
    )
    check_trainable(rows)
    prepared = impute(written(split_rows(rows, TEST_SHARE, seed), "split"))
    model = fit_model(prepared.where(~F.col("is_test")), seed, **params)
    scored = predict(model, prepared.where("is_test"))
    metrics = model_metrics(scored, LABEL, "probability_of_default").first().asDict()
    if unscored := metrics.pop("unscored_rows"):
        raise ValueError(f"{unscored} test rows have no probability")
    gate(metrics)
    spent = {**fixed, **params, "learner": learner, "seed": seed, "observation_date": observation_date}
    run_id = run_id or uuid.uuid4().hex
    save_model(model, model_path, lake.spark)  # first: a tracked run has its model
    track(lake, run_id, run_rows(lake.spark, run_id, spent, metrics))
    return metrics


def baseline_rows(gold: DataFrame, model: Model, seed: int = 42) -> DataFrame:
    """All Gold rows with income and predicted PD: what weekly logs are compared with."""
    rows = gold.select("user_id", "monthly_volume", "session_regularity")
    if rows.isEmpty():
        raise ValueError("the Gold target table holds no baseline rows")
    return predict(model, with_income(rows, seed)).drop("prediction")
