"""The descriptive bundle over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lapsewise import schemas as S
from lapsewise.operators import profiling as P
from lapsewise.plans.features import Tables


def profile_tables(tables: Tables) -> dict[str, DataFrame]:
    policies, invoices, payments = (
        tables[S.POLICIES],
        tables[S.INVOICE],
        tables[S.PAYHISTORY],
    )
    return {
        "table_counts": P.table_counts(tables),
        "class_balance": P.class_balance(policies),
        "payment_status": P.payment_status_share(policies, invoices, payments),
        "missed_by_status": P.missed_by_status(policies, invoices, payments),
        "policies_per_customer": P.policies_per_customer(policies),
        "products": P.value_counts(policies, "insurance_product"),
        "frequencies": P.value_counts(policies, "payment_frequency"),
    }
