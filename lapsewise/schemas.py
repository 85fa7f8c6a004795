"""Table schemas, keys and the column lists the operators share."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMER = "customer"
POLICIES = "policies"
INVOICE = "invoice"
PAYHISTORY = "payhistory"
RISK_SCORE = "policy_risk_score"


def _table(*columns: tuple[str, T.DataType], required: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in columns])


_TEXT, _DATE, _INT = T.StringType(), T.DateType(), T.IntegerType()
_MONEY = T.DecimalType(12, 2)

FACTORS = T.ArrayType(
    T.StructType([T.StructField("feature", _TEXT), T.StructField("value", T.DoubleType())])
)

SCHEMAS: dict[str, T.StructType] = {
    CUSTOMER: _table(
        ("customer_id", _TEXT),
        ("tax_id", _TEXT),
        ("c_first_name", _TEXT),
        ("c_last_name", _TEXT),
        required=("customer_id",),
    ),
    POLICIES: _table(
        ("insurance_product", _TEXT),
        ("customer_id", _TEXT),
        ("policy_num", _TEXT),
        ("effective_start_date", _DATE),
        ("effective_end_date", _DATE),
        ("payment_frequency", _TEXT),
        ("policy_status", _TEXT),
        ("cancel_date", _DATE),
        required=("policy_num",),
    ),
    INVOICE: _table(
        ("policy_num", _TEXT),
        ("invoice_num", _TEXT),
        ("invoice_type", _TEXT),
        ("invoice_start_date", _DATE),
        ("invoice_end_date", _DATE),
        ("days_arrears_allowed", _INT),
        ("installment_num", _INT),
        ("premium", _MONEY),
        required=("invoice_num",),
    ),
    PAYHISTORY: _table(
        ("transaction_id", _TEXT),
        ("invoice_num", _TEXT),
        ("premium", _MONEY),
        ("pay_transaction_date", _DATE),
        ("pay_transaction_status", _TEXT),
        required=("transaction_id",),
    ),
    RISK_SCORE: _table(
        ("policy_num", _TEXT),
        ("scored_at", T.TimestampNTZType()),
        ("churn_probability", T.DecimalType(5, 4)),
        ("segment_label", _TEXT),
        ("top_factors", FACTORS),
        ("recommended_action", _TEXT),
        required=("policy_num", "scored_at"),
    ),
}

HIDDEN_PROFILE_SCHEMA = _table(
    ("policy_num", _TEXT), ("hidden_profile", _TEXT), required=("policy_num",)
)

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    CUSTOMER: ("customer_id",),
    POLICIES: ("policy_num",),
    INVOICE: ("invoice_num",),
    PAYHISTORY: ("transaction_id",),
    RISK_SCORE: ("policy_num", "scored_at"),
}

# child table -> (foreign key column, parent table)
FOREIGN_KEYS: dict[str, tuple[str, str]] = {
    POLICIES: ("customer_id", CUSTOMER),
    INVOICE: ("policy_num", POLICIES),
    PAYHISTORY: ("invoice_num", INVOICE),
    RISK_SCORE: ("policy_num", POLICIES),
}

# names of the tables in files and databases, where they differ from the ones above
SOURCE_NAMES: dict[str, str] = {
    CUSTOMER: "tbl_customer",
    POLICIES: "tbl_policies",
    INVOICE: "tbl_invoice",
    PAYHISTORY: "tbl_payhistory",
    RISK_SCORE: "tbl_policy_risk_score",
}

# one row per score batch of a committed write: when, in which partition, how many policies
BATCH_LOG = "score_batch_log"
BATCH_LOG_SCHEMA = _table(
    ("scored_at", T.TimestampNTZType()),
    ("scored_date", _DATE),
    ("n_rows", T.LongType()),
    ("write_id", T.StringType()),
    required=("scored_at",),
)

# parents before children
LOAD_ORDER: tuple[str, ...] = (CUSTOMER, POLICIES, INVOICE, PAYHISTORY)


def date_columns(table: str) -> list[str]:
    return [f.name for f in SCHEMAS[table].fields if isinstance(f.dataType, T.DateType)]


# Model inputs. Ratios rather than counts; never the label or the status.
BEHAVIOUR_FEATURES: list[str] = [
    "missed_invoice_ratio",
    "failed_invoice_ratio",
    "late_invoice_ratio",
    "avg_days_late",
    "max_days_late",
    "trend_failed_rate_delta",
    "trend_late_rate_delta",
    "tenure_days",
]
CATEGORICAL_FEATURES: list[str] = ["insurance_product", "payment_frequency"]
LABEL = "is_churned"
