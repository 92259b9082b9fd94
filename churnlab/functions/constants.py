"""Fixed values.

These must equal the values the original tool uses for results to match: the
risk-band edges, label lists, the plan price list and the business names of
features.  They are data, kept together here in their natural order.
"""

from __future__ import annotations

# --- fixed values: risk bands (label, exclusive lower edge, inclusive upper edge)
RISK_BANDS: list[tuple[str, float, float]] = [
    ("low", -0.01, 0.30),
    ("medium", 0.30, 0.60),
    ("high", 0.60, 1.0),
]

# --- fixed values: retention priority labels, lowest quartile first
PRIORITY_LABELS: list[str] = ["low", "medium", "high", "critical"]

# --- fixed values: quota shares of the demo sample per risk band
QUOTA_SHARES: list[tuple[str, float]] = [("high", 0.5), ("medium", 0.3)]
QUOTA_REST_BAND = "low"

# --- fixed values: candidate complaint labels, in this order
COMPLAINT_LABELS: list[str] = [
    "billing",
    "network outage",
    "slow internet",
    "device problem",
    "activation issue",
    "pricing complaint",
    "cancellation request",
]

# --- fixed values: technical feature name (after prefix strip and '_' -> ' ')
# to business label; names not listed pass through unchanged
FEATURE_LABELS: dict[str, str] = {
    "contract type month to month": "month-to-month contract",
    "contract type one year": "one-year contract",
    "contract type two year": "two-year contract",
    "internet service fiber optic": "fiber optic internet",
    "internet service dsl": "DSL internet",
    "payment method electronic check": "electronic check payment",
    "payment method mailed check": "mailed check payment",
    "tenure months": "customer tenure",
    "monthly charges": "monthly charges",
    "total mrr": "total monthly recurring revenue",
    "support ticket count": "support ticket volume",
    "network incident count": "network incident volume",
    "late payment count": "late payment count",
    "late payment rate": "late payment rate",
    "cancellation request count": "cancellation request count",
    "network complaint count": "network complaint count",
    "billing complaint count": "billing complaint count",
    "has byod": "BYOD customer",
    "has mobile": "mobile customer",
    "has 5g": "5G enabled",
}
FEATURE_PREFIXES: list[str] = ["categorical__", "numeric__"]
NO_DRIVER_LABEL = "No additional positive driver"
TOP_FACTOR_COUNT = 3

# --- fixed values: fixed-line plan by internet service, and download speed
FIXED_PLANS: list[tuple[str, str, int]] = [
    ("fiber_optic", "Fiber Max", 500),
    ("dsl", "DSL Essential", 100),
]
FIXED_PLAN_DEFAULT: tuple[str, int] = ("Voice Only", 0)

# --- fixed values: mobile plan monthly price list
MOBILE_PLAN_PRICES: dict[str, float] = {
    "Mobile Starter": 35.0,
    "Mobile Unlimited": 65.0,
    "Family Share": 95.0,
    "Premium 5G": 85.0,
}

# --- fixed values: provenance label written on every cleaned customer row
SOURCE_SYSTEM = "ibm_telco_sample"

# --- fixed values: columns never used as model inputs
TARGET_COLUMN = "churned"
ID_COLUMNS: list[str] = ["customer_id"]
EXCLUDED_COLUMNS: list[str] = [
    "churned",
    "source_system",
    "is_synthetic",
    "monthly_revenue_at_risk",
]

# Number text as a lenient numeric parser reads it: optional sign, digits with
# optional fraction (or a leading-dot fraction), optional exponent, or infinity.
# Rejects 'nan', '1d', '0x1' and blanks.
NUMERIC_TEXT_PATTERN = r"(?i)^[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"
