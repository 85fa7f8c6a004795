"""Train a model on the feature table and judge it as a cost decision."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise import schemas as S
from lapsewise.fixed_values import (
    COST_FALSE_NEGATIVE,
    COST_FALSE_POSITIVE,
    DEFAULT_THRESHOLD,
    SEED,
    TEST_SHARE,
)
from lapsewise.functions.scalars import ratio_or_zero
from lapsewise.operators import metrics as M
from lapsewise.operators import models
from lapsewise.operators.splitting import mark_test_rows
from lapsewise.workspace import durable

_KEEP = ["policy_num", S.LABEL, *S.BEHAVIOUR_FEATURES, *S.CATEGORICAL_FEATURES]


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    test: DataFrame  # held-out rows, stored


def split_stored(
    table: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Store the model columns once, then split: training passes re-read one row per policy."""
    stored = durable(table.select(_KEEP), "features", key="policy_num")
    marked = mark_test_rows(stored, test_share, seed)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def train(
    table: DataFrame,
    classifier: Estimator | None = None,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
) -> Trained:
    training, test = split_stored(table, test_share, seed)
    return Trained(models.fit_classifier(training, classifier), test)


def held_out_scores(trained: Trained) -> DataFrame:
    """``(policy_num, y, p, prediction)`` of the held-out rows, stored for the many metrics."""
    scored = models.predict(trained.model, trained.test).select(
        "policy_num", F.col(S.LABEL).alias("y"), F.col("churn_probability").alias("p"), "prediction"
    )
    return durable(scored, "held-out-scores")


def train_baseline(table: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """Logistic regression and its held-out precision, recall (class by p > 0.5) and ROC-AUC."""
    trained = train(table)
    scored = held_out_scores(trained)
    predicted, actual = F.col("prediction") == 1, F.col("y") == 1
    both = F.count(F.when(predicted & actual, 1))
    rates = scored.agg(
        ratio_or_zero(both, F.count(F.when(predicted, 1))).alias("precision"),
        ratio_or_zero(both, F.count(F.when(actual, 1))).alias("recall"),
    )
    counts = durable(M.score_counts(scored), "score-counts")
    auc = M.ranking_quality(counts).select("roc_auc").scalar()
    return trained.model, rates.withColumn("roc_auc", auc)


@dataclass(frozen=True)
class Evaluation:
    model: PipelineModel
    scores: DataFrame
    tables: dict[str, DataFrame]  # report, threshold_sweep, calibration


def evaluate_scores(
    scored: DataFrame,
    cost_fp: float = COST_FALSE_POSITIVE,
    cost_fn: float = COST_FALSE_NEGATIVE,
) -> dict[str, DataFrame]:
    """Sweep, calibration and a report: metrics at 0.5 and at the cheapest threshold."""
    counts = durable(M.score_counts(scored), "score-counts")
    # the chosen threshold is one of the swept ones, so its row is already there
    sweep = durable(
        M.with_expected_cost(M.threshold_sweep(counts), cost_fp, cost_fn), "threshold-sweep"
    )
    chosen = M.cheapest_threshold(sweep)
    names = ["threshold", "precision", "recall", "f1", "roc_auc", "pr_auc", *M.CELLS]
    row = F.struct(*names)
    at_chosen = sweep.where(F.col("threshold") == chosen.select("threshold").scalar())
    report = M.threshold_sweep(counts, [DEFAULT_THRESHOLD]).select(
        row.alias("default_threshold_metrics"),
        chosen.select("threshold").scalar().alias("cost_weighted_threshold"),
        at_chosen.select(row).scalar().alias("cost_weighted_metrics"),
    )
    return {
        "report": report,
        "threshold_sweep": sweep.orderBy("position").drop("position"),
        "calibration": M.calibration_table(counts).select(
            "mean_predicted_probability", "observed_churn_rate"
        ),
    }


def full_evaluation(
    table: DataFrame,
    classifier: Estimator | None = None,
    cost_fp: float = COST_FALSE_POSITIVE,
    cost_fn: float = COST_FALSE_NEGATIVE,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
) -> Evaluation:
    trained = train(table, classifier, test_share, seed)
    scored = held_out_scores(trained)
    return Evaluation(trained.model, scored, evaluate_scores(scored, cost_fp, cost_fn))
