"""Deterministic stand-ins for model output, so that everything downstream of a
model has an exact answer: a fixed logistic score, clusters by failed ratio and
linear contributions ``beta * (x - mean)``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.functions.advice import top_factors
from lapsewise.operators.scores import score_row
from lapsewise.operators.segments import label_segments
from lapsewise.schemas import BEHAVIOUR_FEATURES

INTERCEPT = -1.5
BETAS = {
    "missed_invoice_ratio": 1.1,
    "failed_invoice_ratio": 2.2,
    "late_invoice_ratio": 0.4,
    "avg_days_late": 0.03,
    "max_days_late": 0.01,
    "trend_failed_rate_delta": 0.8,
    "trend_late_rate_delta": 0.5,
    "tenure_days": -0.002,
}
# the second batch is scored a day later, a little higher
BATCHES = [(datetime(2026, 1, 1, 6, 0, 0), 0.0), (datetime(2026, 1, 2, 6, 0, 0), 0.25)]


def with_score(table: DataFrame, shift: float = 0.0) -> DataFrame:
    """``y`` and ``p`` columns next to the feature columns."""
    linear = F.lit(INTERCEPT + shift)
    for name, beta in BETAS.items():
        linear = linear + F.lit(beta) * F.col(name)
    p = F.round(1 / (1 + F.exp(-F.round(linear, 9))), 6)
    return table.withColumn("y", F.col("is_churned")).withColumn("p", p)


def with_cluster(table: DataFrame) -> DataFrame:
    """Cluster ids on purpose not in order of severity."""
    ratio = F.col("failed_invoice_ratio")
    return table.withColumn(
        "cluster", F.when(ratio == 0, 2).when(ratio <= 0.5, 0).otherwise(1)
    )


def with_linear_contributions(table: DataFrame) -> DataFrame:
    means = table.agg(F.struct(*[F.avg(c).alias(c) for c in BEHAVIOUR_FEATURES]).alias("m")).scalar()
    contributions = F.array(
        *[F.lit(BETAS[c]) * (F.col(c) - F.col(f"_m.{c}")) for c in BEHAVIOUR_FEATURES]
    )
    return table.withColumn("_m", means).withColumn("contributions", contributions).drop("_m")


def factors(n: int = 3):
    return top_factors(F.col("contributions"), BEHAVIOUR_FEATURES, n)


def history(table: DataFrame) -> DataFrame:
    """Two score batches of the same policies."""
    labelled = label_segments(with_linear_contributions(with_cluster(table)))
    batches = None
    for scored_at, shift in BATCHES:
        batch = (
            with_score(labelled, shift)
            .withColumn("churn_probability", F.col("p"))
            .select(score_row(scored_at, factors()))
        )
        batches = batch if batches is None else batches.unionByName(batch)
    return batches
