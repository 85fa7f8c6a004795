"""Fixed values.

These texts and numbers are part of the results themselves (they are stored in
score batches and counted in reports), so they are stated here as plain data.
"""

ACTIVE = "Active"
CANCELLED = "Cancelled"
EXPIRED = "Expired"
POLICY_STATUSES = [ACTIVE, CANCELLED, EXPIRED]

FAILED = "Failed"
PAID = "Paid"
PAID_LATE = "Paid Late"
PAYMENT_STATUSES = [FAILED, PAID, PAID_LATE]

LOW_RISK = "Low risk"
SEGMENT_NAMES = [LOW_RISK, "Medium risk", "High risk"]

DEFAULT_THRESHOLD = 0.5
COST_FALSE_POSITIVE = 1.0
COST_FALSE_NEGATIVE = 5.0
TEST_SHARE = 0.2
SEED = 42
TOP_FACTORS = 3

# Outcome-adjacent, so never advised on.
NOT_ACTIONABLE = "tenure_days"

# Every action reads "headline - explanation"; reports count by headline.
ACTIONS = {
    "missed_invoice_ratio": "Proactive outreach before the next invoice is due - this policy has a history of invoices going unpaid entirely.",
    "failed_invoice_ratio": "Prompt a payment-method update - repeated failed payment attempts usually mean an expired card or a bank-side decline.",
    "late_invoice_ratio": "Offer a flexible due date or grace-period plan - payments are consistently landing late rather than failing outright.",
    "avg_days_late": "Send payment reminders earlier in the billing cycle - payments are landing well past the arrears window on average.",
    "max_days_late": "Escalate to a retention call - at least one payment ran very late relative to the arrears window.",
    "trend_failed_rate_delta": "Escalate to the retention team - the failure rate has been getting worse in this policy's more recent invoices.",
    "trend_late_rate_delta": "Proactive check-in call - lateness has been trending worse in this policy's more recent invoices.",
}
DEFAULT_ACTION = "Monitor - no single actionable behavioral driver stands out, but the model still flags this policy as at risk."

DESCRIPTIONS = {
    "missed_invoice_ratio": "History of missed payments",
    "failed_invoice_ratio": "Repeated failed payment attempts",
    "late_invoice_ratio": "Payments consistently arriving late",
    "avg_days_late": "Payments landing well past the due window, on average",
    "max_days_late": "At least one payment ran very late",
    "trend_failed_rate_delta": "Payment failures have been getting worse recently",
    "trend_late_rate_delta": "Lateness has been trending worse recently",
}

REPORT_HEADINGS = {
    "policy_num": "Policy",
    "churn_probability": "Churn Risk",
    "segment_label": "Segment",
    "insurance_product": "Product",
    "payment_frequency": "Payment Frequency",
    "policy_status": "Status",
    "recommended_action": "Suggested Action",
    "why_flagged": "Why Flagged",
}
