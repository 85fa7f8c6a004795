"""Billing tables derived from an order-history star schema.

Customers hold two policies each, orders are invoices and line items are
payment attempts. Every rule is a row-wise expression over whole tables (one
key join for payments, no windows), so deriving the tables never adds a
shuffle that a hot customer could stall.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapsewise import schemas as S

_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

_POLICY_OF_ORDER = "(o_custkey * 2 + o_orderkey % 2)"
_ARREARS = "cast(30 * (1 + o_orderkey % 3) AS int)"


def _spread(policy: str) -> str:
    """0..99, spread over policies; under 24 is cancelled, under 50 active."""
    return f"({policy} * 7919 % 100)"


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "customer").selectExpr(
        "cast(c_custkey AS string) AS customer_id",
        "cast(c_nationkey AS string) AS tax_id",
        "split_part(c_name, '#', 1) AS c_first_name",
        "split_part(c_name, '#', 2) AS c_last_name",
    )


def policies(spark: SparkSession, folder: str) -> DataFrame:
    numbered = _read(spark, folder, "customer").selectExpr(
        "c_custkey", "c_mktsegment", "explode(array(c_custkey * 2, c_custkey * 2 + 1)) AS n"
    )
    dated = numbered.selectExpr(
        "*",
        "date_add(date '1995-01-01', cast(n * 37 % 2000 AS int)) AS start",
        f"CASE WHEN {_spread('n')} < 24 THEN 'Cancelled'"
        f" WHEN {_spread('n')} < 50 THEN 'Active' ELSE 'Expired' END AS policy_status",
    )
    return dated.selectExpr(
        "c_mktsegment AS insurance_product",
        "cast(c_custkey AS string) AS customer_id",
        "cast(n AS string) AS policy_num",
        "start AS effective_start_date",
        "date_add(start, 365) AS effective_end_date",
        "element_at(array('Monthly', 'Quarterly', 'Semi-Annual'), cast(n % 3 + 1 AS int)) AS payment_frequency",
        "policy_status",
        "CASE WHEN policy_status = 'Cancelled'"
        " THEN date_add(start, cast(30 + n * 31 % 300 AS int)) END AS cancel_date",
    )


def invoices(spark: SparkSession, folder: str) -> DataFrame:
    day = "cast(o_orderdate AS date)"
    return _read(spark, folder, "orders").selectExpr(
        f"cast({_POLICY_OF_ORDER} AS string) AS policy_num",
        "cast(o_orderkey AS string) AS invoice_num",
        "'Premium' AS invoice_type",
        f"{day} AS invoice_start_date",
        f"date_add({day}, 30) AS invoice_end_date",
        f"{_ARREARS} AS days_arrears_allowed",
        # the day number: same order as numbering the orders 1, 2, 3 by date
        f"datediff({day}, date '1995-01-01') AS installment_num",
        "cast(o_totalprice AS decimal(12,2)) AS premium",
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    # the text key before the join: grouping by it later needs no second shuffle
    orders = _read(spark, folder, "orders").selectExpr(
        "cast(o_orderkey AS string) AS invoice_num",
        "cast(o_orderdate AS date) AS billed",
        f"{_spread(_POLICY_OF_ORDER)} < 24 AS cancelled",
        f"{_ARREARS} AS arrears",
    )
    items = _read(spark, folder, "lineitem").selectExpr("*", "cast(l_orderkey AS string) AS invoice_num")
    lagged = items.join(orders, "invoice_num").selectExpr(
        "*", "pmod(datediff(l_shipdate, billed), 75) AS lag"
    )
    return lagged.selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id",
        "invoice_num",
        "cast(l_extendedprice AS decimal(12,2)) AS premium",
        "date_add(billed, lag) AS pay_transaction_date",
        "CASE WHEN l_returnflag = 'R' AND (l_linestatus = 'O' OR cancelled) THEN 'Failed'"
        " WHEN lag > arrears THEN 'Paid Late' ELSE 'Paid' END AS pay_transaction_status",
    )


def hidden_profile(spark: SparkSession, folder: str) -> DataFrame:
    return policies(spark, folder).selectExpr(
        "policy_num",
        "CASE WHEN policy_status = 'Cancelled' THEN 'churned'"
        " WHEN cast(policy_num AS bigint) % 2 = 0 THEN 'at_risk' ELSE 'good' END AS hidden_profile",
    )


def billing_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        S.CUSTOMER: customers(spark, folder),
        S.POLICIES: policies(spark, folder),
        S.INVOICE: invoices(spark, folder),
        S.PAYHISTORY: payments(spark, folder),
    }
