"""Column names and fixed values shared by every module."""

CUSTOMER = "unique_customer_identifier"
LABEL = "is_churned"
SCORE = "churn_probability"

# --- Fixed values: these must equal the published ones for results to match ---

CHURNER = "Churner"
NON_CHURNER = "Non-churner"
UNKNOWN = "Unknown"
NULL_TEXT = "null"  # what an open cease carries in its completion date
MISSING_LABEL = "None"  # the text a missing category is encoded as

CALL_DAYS = (30, 60, 90)
TYPED_CALL_DAYS = (30, 90)
TALK_DAYS = (30, 90)
USAGE_DAYS = (30, 60)
NO_CALL_RECENCY = 91
NO_USAGE_RECENCY = 60
REPEAT_CALLER_CALLS = 3
NEAR_END_OF_CONTRACT_DAYS = 60

# column suffix -> call_type text
CALL_TYPES = {
    "loyalty": "Loyalty",
    "tech": "Tech",
    "csb": "CS&B",
    "finance": "Customer Finance",
}

# (upper limit in days, exclusive, label); the last label has no limit
TENURE_FEATURE_BANDS = (
    (30, "0–1 month"),
    (90, "1–3 months"),
    (180, "3–6 months"),
    (365, "6–12 months"),
    (540, "12–18 months"),
    (730, "18–24 months"),
    (None, "24+ months"),
)
TENURE_REPORT_BANDS = (
    (90, "0–3 months"),
    (180, "3–6 months"),
    (365, "6–12 months"),
    (730, "1–2 years"),
    (1095, "2–3 years"),
    (None, "3+ years"),
)

CATEGORICAL_FEATURES = ("contract_status", "tenure_bucket", "sales_channel", "technology")

TEST_FRACTION = 0.2
SEED = 42
HIGH_RISK_THRESHOLD = 0.7
HIGH_RISK_TOP_N = 100
EXPERIMENT = "telecom_churn"

# hyper-parameter grid of the randomised search, by our parameter names
SEARCH_GRID = {
    "trees": (100, 200, 300),
    "depth": (3, 5, 7, 9),
    "rate": (0.01, 0.05, 0.1),
    "row_fraction": (0.7, 0.8, 0.9, 1.0),
    "column_fraction": (0.7, 0.8, 0.9, 1.0),
    "min_child_rows": (1, 3, 5),
    "min_gain": (0.0, 0.1, 0.2),
}

# --- Names of the feature columns, generated where they follow a rule ---

CALL_FEATURES = (
    tuple(f"calls_total_{d}d" for d in CALL_DAYS)
    + tuple(f"calls_{kind}_{d}d" for kind in CALL_TYPES for d in TYPED_CALL_DAYS)
    + ("days_since_last_call", "call_type_diversity_90d", "repeat_caller_flag_30d")
)
TALK_FEATURES = tuple(
    f"{kind}_time_total_{d}d" for kind in ("talk", "hold") for d in TALK_DAYS
) + ("avg_talk_time_per_call_90d", "hold_ratio_90d")
PAYMENT_FEATURES = (
    "contract_dd_cancels",
    "dd_cancel_60_day",
    "any_contract_dd_cancel",
    "any_dd_cancel_60d",
)
CONTRACT_FEATURES = (
    "ooc_days",
    "contract_status",
    "is_out_of_contract",
    "is_near_ooc",
    "tenure_bucket",
)
USAGE_FEATURES = ("usage_drop_pct_28d",)
PRODUCT_FEATURES = (
    "sales_channel",
    "technology",
    "speed",
    "line_speed",
    "speed_gap",
    "speed_gap_pct",
)
FEATURES = (
    CALL_FEATURES
    + TALK_FEATURES
    + PAYMENT_FEATURES
    + CONTRACT_FEATURES
    + USAGE_FEATURES
    + PRODUCT_FEATURES
)
NUMERIC_FEATURES = tuple(c for c in FEATURES if c not in CATEGORICAL_FEATURES)
