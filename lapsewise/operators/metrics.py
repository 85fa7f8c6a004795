"""Evaluation of a probability column against a 0/1 label.

Every metric is a function of the distinct scores and their label counts
(:func:`score_counts`): tied scores are one row, and the table is worth storing
once when several metrics follow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.fixed_values import COST_FALSE_NEGATIVE, COST_FALSE_POSITIVE, DEFAULT_THRESHOLD
from lapsewise.functions.scalars import ratio_or_zero
from lapsewise.operators.ordering import running_totals

DEFAULT_THRESHOLDS = [i / 20 for i in range(1, 20)]

CELLS = ["true_negative", "false_positive", "false_negative", "true_positive"]


def score_counts(scored: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """One row per distinct score: churned (``pos``) and kept (``neg``) rows with it."""
    positive = F.col(label) == 1
    return scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count(F.when(positive, 1)).alias("pos"), F.count(F.when(~positive, 1)).alias("neg")
    )


def confusion_counts(counts: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row with all four cells; flagged means ``score >= threshold``."""
    return _cells_per_threshold(counts, [float(threshold)]).select(*CELLS)


def _cells_per_threshold(counts: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Position, threshold and the four cells, in the order given.

    Each score is placed between the thresholds, so one small aggregate (a row
    per gap) replaces a pass or a copy of the scores per threshold. The
    thresholds then add up the gaps above them.
    """
    ordered = sorted(set(thresholds))
    gap = F.size(F.filter(F.array(*[F.lit(t) for t in ordered]), lambda t: t <= F.col("score")))
    gaps = (
        counts.groupBy(gap.alias("gap"))
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .agg(F.collect_list(F.struct("gap", "pos", "neg")).alias("gaps"))
    )
    points = F.array(
        *[F.struct(F.lit(t).alias("threshold"), F.lit(ordered.index(t) + 1).alias("gap")) for t in thresholds]
    )

    def total(count: str, flagged: bool) -> Column:
        def counted(gap: Column) -> Column:
            at_or_above = gap["gap"] >= F.col("point.gap")
            return F.when(at_or_above if flagged else ~at_or_above, gap[count]).otherwise(0)

        zero = F.lit(0).cast("bigint")
        return F.aggregate("gaps", zero, lambda sum_, gap: sum_ + counted(gap))

    return gaps.select("gaps", F.posexplode(points).alias("position", "point")).select(
        "position",
        "point.threshold",
        total("neg", False).alias("true_negative"),
        total("neg", True).alias("false_positive"),
        total("pos", False).alias("false_negative"),
        total("pos", True).alias("true_positive"),
    )


def _rates() -> list[Column]:
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    return [
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def ranking_quality(counts: DataFrame) -> DataFrame:
    """One row: ``roc_auc`` (ties count half) and ``pr_auc`` (step-sum average precision).

    ROC-AUC is NULL unless both classes occur; average precision is 0 without positives.
    """
    ranked = running_totals(counts, ["score"], ["pos", "neg"])
    totals = counts.agg(
        F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).alias("t")
    ).scalar()
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    # rows scored at least as high as this score
    pos_at, neg_at = F.col("all.pos") - F.col("pos_before"), F.col("all.neg") - F.col("neg_before")
    summed = ranked.withColumn("all", totals).agg(
        F.sum(pos * (F.col("neg_before") + neg / 2)).alias("pairs_won"),
        F.sum(pos * pos_at / (pos_at + neg_at)).alias("precision_steps"),
        F.sum(pos).alias("n_pos"),
        F.sum(neg).alias("n_neg"),
    )
    return summed.select(
        F.when(
            (F.col("n_pos") > 0) & (F.col("n_neg") > 0),
            F.col("pairs_won") / (F.col("n_pos") * F.col("n_neg")),
        ).alias("roc_auc"),
        ratio_or_zero(F.col("precision_steps"), F.col("n_pos")).alias("pr_auc"),
    )


def threshold_sweep(counts: DataFrame, thresholds: Sequence[float] | None = None) -> DataFrame:
    """Metrics and confusion counts per threshold, in the order given.

    The threshold-free metrics are computed once and attached to every row.
    """
    points = [float(t) for t in (DEFAULT_THRESHOLDS if thresholds is None else thresholds)]
    if not points:
        raise ValueError("at least one threshold is needed")
    quality = ranking_quality(counts).select(F.struct("roc_auc", "pr_auc").alias("q")).scalar()
    return (
        _cells_per_threshold(counts, points)
        .withColumn("q", quality)
        .select("position", "threshold", *_rates(), "q.roc_auc", "q.pr_auc", *CELLS)
        .orderBy("position")
    )


def compute_metrics(counts: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row: precision, recall and F1 at ``threshold``, ROC-AUC and average precision."""
    return threshold_sweep(counts, [threshold]).drop("position", *CELLS)


def with_expected_cost(
    sweep: DataFrame,
    cost_fp: float = COST_FALSE_POSITIVE,
    cost_fn: float = COST_FALSE_NEGATIVE,
) -> DataFrame:
    cost = F.col("false_positive") * float(cost_fp) + F.col("false_negative") * float(cost_fn)
    return sweep.withColumn("expected_cost", cost)


def cheapest_threshold(sweep: DataFrame) -> DataFrame:
    """One row: the threshold of least expected cost, the first listed on a tie."""
    cheapest = F.struct("expected_cost", "position")
    return sweep.agg(
        F.min_by("threshold", cheapest).alias("threshold"),
        F.min("expected_cost").alias("expected_cost"),
    )


def score_quantiles(counts: DataFrame, n: int) -> DataFrame:
    """The n + 1 exact quantiles i / n of the scores, interpolated between order statistics.

    ``counts`` comes from :func:`score_counts`. Distinct scores know which ranks
    they cover from running totals, so no task buffers the distribution.
    """
    sized = counts.withColumn("n_rows", F.col("pos") + F.col("neg"))
    ranked = running_totals(sized, ["score"], ["n_rows"])

    # the i-th quantile lies between two ranks, ``part`` of the way
    position = F.col("q.share") * (F.col("total") - 1)
    wanted = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(i * (1.0 / n)).alias("share")) for i in range(n + 1)]
    )
    ranks = (
        sized.agg(F.sum("n_rows").alias("total"))
        .select("total", F.explode(wanted).alias("q"))
        .select("q.i", F.floor(position).alias("low"), (position - F.floor(position)).alias("part"))
    )
    all_ranks = ranks.agg(F.collect_list(F.struct("i", "low", "part"))).scalar()

    first, last = F.col("n_rows_before"), F.col("n_rows_before") + F.col("n_rows") - 1
    covered = (
        ranked.withColumn("_ranks", all_ranks)
        .withColumn(
            "q",
            F.explode(
                F.filter(
                    "_ranks",
                    lambda r: r["low"].between(first, last) | (r["low"] + 1).between(first, last),
                )
            ),
        )
        .select("score", "q.*", first.alias("first"), last.alias("last"))
    )

    def score_at(rank: Column) -> Column:
        return F.max(F.when(rank.between(F.col("first"), F.col("last")), F.col("score")))

    low, high, part = score_at(F.col("low")), score_at(F.col("low") + 1), F.max("part")
    gap = F.coalesce(high, low) - low
    return covered.groupBy("i").agg(
        F.when(part < 0.5, low + gap * part)
        .otherwise(low + gap - gap * (1 - part))
        .alias("edge")
    )


def calibration_table(counts: DataFrame, n_bins: int = 10) -> DataFrame:
    """Mean prediction against observed rate, per non-empty quantile bin.

    A score belongs to the bin numbered by the inner edges strictly below it,
    so repeated edges merge their bins.
    """
    inner = score_quantiles(counts, n_bins).where(F.col("i").between(1, n_bins - 1))
    edges = inner.agg(F.sort_array(F.collect_list("edge"))).scalar()
    n_rows = F.col("pos") + F.col("neg")
    return (
        counts.withColumn("_edges", edges)
        .withColumn("bin", F.size(F.filter("_edges", lambda e: e < F.col("score"))))
        .groupBy("bin")
        .agg(
            F.sum(n_rows).alias("n_rows"),
            (F.sum(F.col("score") * n_rows) / F.sum(n_rows)).alias("mean_predicted_probability"),
            (F.sum("pos") / F.sum(n_rows)).alias("observed_churn_rate"),
        )
        .orderBy("bin")
    )
