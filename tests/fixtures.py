"""Small hand-made tables."""

from datetime import date
from decimal import Decimal

import numpy as np

from lapsewise import schemas as S

NUMBERS = ", ".join(f"{c} double" for c in S.BEHAVIOUR_FEATURES)
FEATURE_ROWS = (
    "policy_num string, customer_id string, insurance_product string, payment_frequency string, "
    f"policy_status string, is_churned int, {NUMBERS}"
)


def day(text):
    return date.fromisoformat(text) if text else None


def invoices(spark, rows):
    """(invoice, policy, installment, start, arrears)"""
    full = [
        (policy, invoice, "Premium", day(start), None, arrears, installment, Decimal("10.00"))
        for invoice, policy, installment, start, arrears in rows
    ]
    return spark.createDataFrame(full, S.SCHEMAS[S.INVOICE])


def payments(spark, rows):
    """(transaction, invoice, date, status)"""
    full = [(t, i, Decimal("10.00"), day(d), s) for t, i, d, s in rows]
    return spark.createDataFrame(full, S.SCHEMAS[S.PAYHISTORY])


def policies(spark, rows):
    """(policy, status, start, end, cancelled)"""
    full = [("Auto", "C1", p, day(a), day(b), "Monthly", s, day(c)) for p, s, a, b, c in rows]
    return spark.createDataFrame(full, S.SCHEMAS[S.POLICIES])


def one_driver(spark, per_class=20, seed=7, status="Active"):
    """Noise everywhere, except that churned policies fail far more often."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(2 * per_class):
        churned = int(i >= per_class)
        noise = {c: float(rng.uniform(0, 0.2)) for c in S.BEHAVIOUR_FEATURES}
        noise["tenure_days"] = float(rng.integers(100, 400))
        noise["failed_invoice_ratio"] = float(rng.uniform(0.6, 0.9) if churned else rng.uniform(0, 0.3))
        rows.append(
            (
                f"P{i:03d}",
                f"C{i:03d}",
                ["Auto", "Home"][int(rng.integers(2))],
                ["Monthly", "Quarterly"][int(rng.integers(2))],
                status,
                churned,
                *[noise[c] for c in S.BEHAVIOUR_FEATURES],
            )
        )
    return spark.createDataFrame(rows, FEATURE_ROWS)
