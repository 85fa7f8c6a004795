"""Why a forest scores held-out policies as it does, overall and for the riskiest one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.operators import attribution as A
from lapsewise.operators import models
from lapsewise.plans.training import Trained
from lapsewise.workspace import durable


def explain_held_out(trained: Trained, top_n: int = 5) -> dict[str, DataFrame]:
    """``contributions`` per policy, ``importance`` per feature, ``riskiest`` policy's factors."""
    names = models.feature_names(trained.model)
    scored = models.predict(trained.model, trained.test)
    explained = durable(
        A.with_contributions(scored, trained.model).select(
            "policy_num", "features", "churn_probability", "contributions", "base_value"
        ),
        "explained",
    )
    riskiest = A.riskiest_policy(explained).select("policy_num").scalar()
    return {
        "contributions": explained,
        "importance": A.feature_importance(explained, names),
        "riskiest": A.ranked_factors(
            explained.where(F.col("policy_num") == riskiest), names, top_n
        ).orderBy("rank"),
    }
