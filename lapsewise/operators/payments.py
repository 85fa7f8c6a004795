"""Payments and invoices: how late, how often failed, never paid at all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.fixed_values import FAILED, PAID_LATE
from lapsewise.functions.scalars import at_least_zero, is_value, whole_days


def payment_lateness(payments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Every payment of a known invoice with ``days_late``: days beyond the arrears window.

    A failed attempt has no arrival to judge, so its lateness is NULL. The
    invoice side is unique, so a much-retried invoice only makes the payment
    side uneven, which adaptive execution splits.
    """
    terms = invoices.select("invoice_num", "policy_num", "invoice_start_date", "days_arrears_allowed")
    failed = is_value(F.col("pay_transaction_status"), FAILED)
    overrun = (
        whole_days(F.col("pay_transaction_date"), F.col("invoice_start_date"))
        - F.col("days_arrears_allowed")
    )
    return payments.join(terms, "invoice_num").withColumn(
        "days_late", F.when(~failed, at_least_zero(overrun))
    )


def payments_per_invoice(payments: DataFrame) -> DataFrame:
    """One row per invoice that has any payment row, combined before the shuffle.

    The terms of an invoice are the same for all its payments, so its worst
    lateness comes from its last settled date alone and the payments never
    need to be joined one by one.
    """
    status = F.col("pay_transaction_status")
    failed = is_value(status, FAILED)
    return (
        payments.where(F.col("invoice_num").isNotNull())
        .groupBy("invoice_num")
        .agg(
            F.count(F.when(failed, 1)).alias("failed_attempts"),
            F.max(is_value(status, PAID_LATE)).alias("was_paid_late"),
            F.max(F.when(~failed, F.col("pay_transaction_date"))).alias("last_settled_date"),
        )
    )


def invoice_summary(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per invoice: missed, failed, late, and its worst lateness in days."""
    overrun = (
        whole_days(F.col("last_settled_date"), F.col("invoice_start_date"))
        - F.col("days_arrears_allowed")
    )
    attempts = F.coalesce(F.col("failed_attempts"), F.lit(0).cast("bigint"))
    return (
        invoices.select(
            "invoice_num", "policy_num", "installment_num", "invoice_start_date", "days_arrears_allowed"
        )
        .join(payments_per_invoice(payments), "invoice_num", "left")
        .select(
            "invoice_num",
            "policy_num",
            "installment_num",
            attempts.alias("failed_attempts"),
            F.coalesce("was_paid_late", F.lit(False)).alias("was_paid_late"),
            at_least_zero(overrun).alias("max_days_late"),
            F.col("failed_attempts").isNull().alias("was_missed"),
            (attempts > 0).alias("had_failed_attempt"),
        )
    )


def missed_invoices(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Invoices without a single payment row, known or unknown status alike."""
    paid = payments.select("invoice_num").where(F.col("invoice_num").isNotNull()).distinct()
    return invoices.join(paid, "invoice_num", "left_anti")
