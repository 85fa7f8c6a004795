"""Per-policy payment behaviour: the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lapsewise.fixed_values import ACTIVE, CANCELLED
from lapsewise.functions.scalars import is_value, whole_days
from lapsewise.operators.payments import invoice_summary

PAYMENT_FEATURES = [
    "total_invoices",
    "missed_invoice_count",
    "missed_invoice_ratio",
    "failed_invoice_count",
    "failed_invoice_ratio",
    "late_invoice_count",
    "late_invoice_ratio",
    "avg_days_late",
    "max_days_late",
    "trend_failed_rate_delta",
    "trend_late_rate_delta",
]


FLAGS = {"failed": "had_failed_attempt", "late": "was_paid_late"}
SUMS = ["missed", *FLAGS, "judged", "days_late"]
CELL = ["policy_num", "installment_num"]
#: An installment of so many invoices is put in order by one task.
RANKED_ROWS = 100_000


def _with_early(cells: DataFrame) -> DataFrame:
    """Add to counted installments (policy, installment, n) how many invoices their policy's early half
    takes from each, and whether it takes some but not all: of one installment a policy at most."""
    policy = W.partitionBy("policy_num")
    earlier = policy.orderBy(F.col("installment_num").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    ahead = cells.withColumns(
        {
            "half": F.ceil(F.sum("n").over(policy) / 2),
            "before": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
        }
    )
    wanted = F.least(F.greatest(F.col("half") - F.col("before"), F.lit(0)), F.col("n"))
    return ahead.withColumn("wanted", wanted).withColumn(
        "is_cut", (F.col("wanted") > 0) & (F.col("wanted") < F.col("n"))
    )


def early_of_cut(invoices: DataFrame, ranked_rows: int = RANKED_ROWS) -> DataFrame:
    """The numbers of the early invoices of the installments in which a policy's half ends.

    Where the halves end follows from counts, and only the invoices of those
    installments are put in order. One of more than ``ranked_rows`` is dealt by
    a hash into even parts, each put in order by itself. The cut lies in a part
    where the part's share of the wanted ones ends, give or take ten standard
    deviations; only the rows so near to it are put in order together. That the
    cut is among them is checked.
    """
    rows = invoices.where(F.col("policy_num").isNotNull()).select(*CELL, "invoice_num")
    cells = rows.groupBy(*CELL).agg(F.count("*").alias("n"))
    inside = [f"cut_{c}" for c in CELL]
    cut = _with_early(cells).where("is_cut").select(*[F.col(c).alias(f"cut_{c}") for c in CELL], "n", "wanted")
    same = (F.col("policy_num") == F.col("cut_policy_num")) & F.col("installment_num").eqNullSafe(F.col("cut_installment_num"))
    parts = F.ceil(F.col("n") / ranked_rows)
    dealt = rows.join(cut, same).select(
        *inside, "invoice_num", "n", "wanted", parts.alias("parts"), F.pmod(F.xxhash64("invoice_num"), parts).alias("part")
    )

    of_part = W.partitionBy(*inside, "part")
    sized = dealt.withColumns({"place": F.row_number().over(of_part.orderBy("invoice_num")), "size": F.count("*").over(of_part)})
    share = F.col("wanted") * F.col("size") / F.col("n")
    margin = F.when(F.col("parts") > 1, F.ceil(5 * F.sqrt("size"))).otherwise(0)
    near = sized.withColumns(
        {"low": F.greatest(F.floor(share) - margin, F.lit(0)), "high": F.least(F.ceil(share) + margin, F.col("size"))}
    ).withColumn("is_open", (F.col("place") > F.col("low")) & (F.col("place") <= F.col("high")))

    together = W.partitionBy(*inside, F.when(F.col("is_open"), -1).otherwise(F.col("part")))
    below = F.sum(F.when(F.col("is_open") & (F.col("place") == F.col("low") + 1), F.col("low"))).over(together)
    open_early = F.row_number().over(together.orderBy("invoice_num")) <= F.col("wanted") - below
    judged = near.withColumn("is_early", F.when(F.col("is_open"), open_early).otherwise(F.col("place") <= F.col("low")))
    missed = F.col("is_open") & (
        ((F.col("place") == F.col("low") + 1) & (F.col("low") > 0) & ~F.col("is_early"))
        | ((F.col("place") == F.col("high")) & (F.col("high") < F.col("size")) & F.col("is_early"))
    )
    checked = F.when(missed, F.raise_error(F.lit("the half of a policy ends outside the rows near its cut"))).otherwise(F.col("is_early"))
    return judged.where(checked).select("invoice_num")


def policy_features(summary: DataFrame, invoices: DataFrame | None = None) -> DataFrame:
    """Collapse the invoice summary to one row per policy with invoices.

    The trend is the recent half's rate less the early half's, 0 when there is
    no recent half. The early half holds ceil(n / 2) invoices, by installment
    (unknown last), then invoice number: whole installments, and of the one in
    which it ends the first few invoices. ``invoices`` are the rows behind the
    summary, if they are at hand: they are cheaper to count.
    """
    first = early_of_cut(summary if invoices is None else invoices).select(F.col("invoice_num").alias("early_invoice"))
    marked = summary.where(F.col("policy_num").isNotNull()).join(first, F.col("invoice_num") == F.col("early_invoice"), "left")

    def count_of(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    is_first = F.col("early_invoice").isNotNull()
    ahead = _with_early(
        marked.groupBy(*CELL).agg(
            F.count("*").alias("n"),
            count_of(F.col("was_missed")).alias("missed"),
            *[count_of(F.col(flag)).alias(name) for name, flag in FLAGS.items()],
            F.count("max_days_late").alias("judged"),
            F.sum("max_days_late").alias("days_late"),
            F.max("max_days_late").alias("most_days_late"),
            *[count_of(is_first & F.col(flag)).alias(f"first_{name}") for name, flag in FLAGS.items()],
        )
    )

    def early(name: str) -> Column:
        return F.when(F.col("is_cut"), F.col(f"first_{name}")).when(F.col("wanted") > 0, F.col(name)).otherwise(F.lit(0))

    summed = ahead.groupBy("policy_num").agg(
        *[F.sum(c).alias(c) for c in ("n", *SUMS)],
        F.max("most_days_late").alias("most_days_late"),
        F.max("half").alias("half"),
        *[F.sum(early(name)).alias(f"early_{name}") for name in FLAGS],
    )
    n, half = F.col("n"), F.col("half")

    def counted(name: str) -> list[Column]:
        return [
            F.col(name).alias(f"{name}_invoice_count"),
            (F.col(name) / n).alias(f"{name}_invoice_ratio"),
        ]

    def trend(name: str) -> Column:
        recent = (F.col(name) - F.col(f"early_{name}")) / F.when(n > half, n - half)
        return F.coalesce(recent - F.col(f"early_{name}") / half, F.lit(0.0))

    return summed.select(
        "policy_num",
        n.alias("total_invoices"),
        *counted("missed"),
        *counted("failed"),
        *counted("late"),
        F.coalesce(F.col("days_late") / F.when(F.col("judged") > 0, F.col("judged")), F.lit(0.0)).alias("avg_days_late"),
        F.coalesce(F.col("most_days_late").cast("double"), F.lit(0.0)).alias("max_days_late"),
        *[trend(name).alias(f"trend_{name}_rate_delta") for name in FLAGS],
    )


def policy_static(policies: DataFrame) -> DataFrame:
    """Tenure and label. A cancelled policy ends on its cancel date, known or not."""
    cancelled = is_value(F.col("policy_status"), CANCELLED)
    end = F.when(cancelled, F.col("cancel_date")).otherwise(F.col("effective_end_date"))
    return policies.select(
        "policy_num",
        "customer_id",
        "insurance_product",
        "payment_frequency",
        "policy_status",
        whole_days(end, F.col("effective_start_date")).alias("tenure_days"),
        cancelled.cast("int").alias("is_churned"),
    )


def feature_table(policies: DataFrame, invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per policy. A policy without invoices has zero payment behaviour.

    Only the payment columns are filled; an unknown tenure stays NULL.
    """
    behaviour = policy_features(invoice_summary(invoices, payments), invoices)
    return (
        policy_static(policies)
        .join(behaviour, "policy_num", "left")
        .na.fill(0, PAYMENT_FEATURES)
    )


def active_policies(table: DataFrame) -> DataFrame:
    return table.where(F.col("policy_status") == ACTIVE)
