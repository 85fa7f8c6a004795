"""Business-facing tables over a joined score batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.fixed_values import LOW_RISK, REPORT_HEADINGS
from lapsewise.functions.advice import why_flagged
from lapsewise.functions.scalars import half_even, headline, ratio_or_zero
from lapsewise.operators.profiling import value_counts


def is_at_risk() -> Column:
    """Any segment but Low risk, an unknown one included. Not a probability cutoff."""
    return ~F.col("segment_label").eqNullSafe(LOW_RISK)


def policy_detail(scores: DataFrame) -> DataFrame:
    """One row per scored policy under business headings."""
    explained = scores.withColumn("why_flagged", why_flagged(F.col("top_factors")))
    return explained.select(*[F.col(c).alias(h) for c, h in REPORT_HEADINGS.items()])


def segment_counts(scores: DataFrame) -> DataFrame:
    return value_counts(scores.select(F.col("segment_label").alias("Segment")), "Segment", "Policies")


def action_counts(scores: DataFrame) -> DataFrame:
    """Policies at risk per suggested action, by its headline."""
    at_risk = scores.where(is_at_risk()).select(
        headline(F.col("recommended_action")).alias("Suggested Action")
    )
    return value_counts(at_risk, "Suggested Action", "Policies")


def summary_headline(scores: DataFrame) -> DataFrame:
    """One row: policies scored, and how many are at risk as ``k (p%)``."""
    counted = scores.agg(F.count("*").alias("n"), F.count(F.when(is_at_risk(), 1)).alias("k"))
    share = half_even(ratio_or_zero(F.col("k"), F.col("n")) * 100, 0).cast("int")
    return counted.select(
        F.col("n").alias("policies_scored"),
        F.format_string("%d (%d%%)", F.col("k"), share).alias("flagged_at_risk"),
    )
