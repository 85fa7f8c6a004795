"""Segments of the whole book, and how they compare with a known profile."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lapsewise.fixed_values import SEED
from lapsewise.operators import agreement as A
from lapsewise.operators.segments import assign_segments, fit_segments, label_segments
from lapsewise.plans.features import Tables, build_feature_table
from lapsewise.workspace import durable


def build_segments(tables: Tables, k: int = 3, seed: int = SEED) -> DataFrame:
    stored = durable(build_feature_table(tables), "features", key="policy_num")
    return label_segments(assign_segments(fit_segments(stored, k, seed), stored))


def compare_to_profile(segmented: DataFrame, profile: DataFrame) -> dict[str, DataFrame]:
    """How far segments and a known profile agree: ``crosstab`` of segment against profile,
    ``coverage`` of the book by the profile, ``adjusted_rand`` of the clusters."""
    matched = A.matched_with_profile(segmented, profile)
    return {
        "crosstab": A.crosstab(matched, "segment_label", "hidden_profile"),
        "coverage": A.profile_coverage(segmented, profile),
        "adjusted_rand": A.adjusted_rand_index(matched, "cluster", "hidden_profile"),
    }
