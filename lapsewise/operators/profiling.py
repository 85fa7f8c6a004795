"""Descriptive tables over the raw billing data."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lapsewise.functions.scalars import percent
from lapsewise.operators.agreement import wide


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per known value, most frequent first (ties by value)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias(name))
        .orderBy(F.desc(name), column)
    )


def class_balance(policies: DataFrame) -> DataFrame:
    """Policies per status and their percentage of all policies with a status."""
    counted = value_counts(policies, "policy_status")
    # one row per status by now
    total = F.sum("n").over(W.partitionBy())
    return counted.withColumn("pct", percent(F.col("n"), total)).orderBy(F.desc("n"), "policy_status")


def payment_status_counts(policies: DataFrame, invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Payments per policy status and payment status: a row for each pair that occurs.

    Payments are counted per invoice, then per policy, each before its join, so
    neither a much-retried invoice nor a large policy reaches a join as more
    than one row per payment status.
    """
    status = "pay_transaction_status"
    per_invoice = (
        payments.where(F.col(status).isNotNull() & F.col("invoice_num").isNotNull())
        .groupBy("invoice_num", status)
        .agg(F.count("*").alias("n"))
    )
    per_policy = (
        per_invoice.join(invoices.select("invoice_num", "policy_num"), "invoice_num")
        .groupBy("policy_num", status)
        .agg(F.sum("n").alias("n"))
    )
    known = policies.select("policy_num", "policy_status").where(F.col("policy_status").isNotNull())
    return (
        per_policy.join(known, "policy_num").groupBy("policy_status", status).agg(F.sum("n").alias("n"))
    )


def payment_status_share(policies: DataFrame, invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Row-normalised crosstab: one column of percentages per payment status that occurs."""
    counts = wide(
        payment_status_counts(policies, invoices, payments), "policy_status", "pay_transaction_status"
    )
    statuses = [c for c in counts.columns if c != "policy_status"]
    everything = reduce(lambda a, b: a + b, [F.col(f"`{s}`") for s in statuses], F.lit(0))
    return counts.select(
        "policy_status", *[percent(F.col(f"`{s}`"), everything).alias(s) for s in statuses]
    ).orderBy("policy_status")


def missed_by_status(policies: DataFrame, invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Per policy status: invoices, how many were ever paid at, missed, percent missed."""
    paid = (
        payments.where(F.col("invoice_num").isNotNull())
        .groupBy("invoice_num")
        .agg(F.lit(1).alias("has_payment"))
    )
    per_policy = (
        invoices.select("invoice_num", "policy_num")
        .join(paid, "invoice_num", "left")
        .groupBy("policy_num")
        .agg(F.count("*").alias("total"), F.count("has_payment").alias("paid"))
    )
    missed = F.col("total") - F.col("paid")
    return (
        per_policy.join(policies.select("policy_num", "policy_status"), "policy_num")
        .where(F.col("policy_status").isNotNull())
        .groupBy("policy_status")
        .agg(F.sum("total").alias("total"), F.sum("paid").alias("paid"))
        .withColumn("missed", missed)
        .withColumn("missed_pct", percent(F.col("missed"), F.col("total")))
        .orderBy("policy_status")
    )


def policies_per_customer(policies: DataFrame) -> DataFrame:
    """Mean, least and most policies among customers that have any."""
    per_customer = (
        policies.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count("*").alias("n"))
    )
    return per_customer.agg(
        F.avg("n").alias("mean_policies"),
        F.min("n").alias("min_policies"),
        F.max("n").alias("max_policies"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
