"""Fixed values shared by every stage: column contracts, the default contact policy, default economics.

Everything in this module is data that results depend on, not behaviour.
"""

from __future__ import annotations

# The 38 model features, in scoring order.
PROFILE_FEATURES = ["city", "bd", "gender", "registered_via", "registration_init_time"]
BILLING_FEATURES = [
    "txn_cnt", "cancel_cnt", "cancel_rate", "auto_renew_cnt", "auto_renew_rate",
    "plan_list_price_mean", "plan_list_price_max", "plan_list_price_min",
    "actual_paid_mean", "actual_paid_max", "actual_paid_min",
    "payment_method_nunique", "txn_first_date", "txn_tenure_days_approx", "membership_expire_date_max",
]
ENGAGEMENT_FEATURES = [
    "log_row_cnt", "log_first_date", "log_last_date", "log_active_days", "log_span_days_approx",
    "total_secs_sum", "total_secs_mean_per_active_day", "total_secs_max_per_day",
    "num_unq_sum", "num_unq_mean_per_active_day", "num_unq_max_per_day",
    "num_25_sum", "num_50_sum", "num_75_sum", "num_985_sum", "num_100_sum",
    "listen_full_share", "listens_per_unique_track",
]
FEATURES = PROFILE_FEATURES + BILLING_FEATURES + ENGAGEMENT_FEATURES

# Spark types of the features when a column has to be added as NULL.
_LONG = {
    "city", "registered_via", "registration_init_time", "txn_cnt", "cancel_cnt", "auto_renew_cnt",
    "payment_method_nunique", "txn_first_date", "txn_tenure_days_approx", "membership_expire_date_max",
    "log_row_cnt", "log_first_date", "log_last_date", "log_active_days", "log_span_days_approx",
}
FEATURE_TYPES = {f: "string" if f == "gender" else "bigint" if f in _LONG else "double" for f in FEATURES}

# Column names of key, label and split date.
KEY, LABEL, TIME = "msno", "is_churn", "txn_last_date"

# Raw table schemas (DDL).
RAW_SCHEMAS = {
    "train": "msno string, is_churn int",
    "members": "msno string, city int, bd int, gender string, registered_via int, registration_init_time int",
    "transactions": "msno string, payment_method_id int, payment_plan_days int, plan_list_price double, "
                    "actual_amount_paid double, is_auto_renew int, transaction_date int, "
                    "membership_expire_date int, is_cancel int",
    "user_logs": "msno string, date int, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, "
                 "num_unq int, total_secs double",
}

# Activity metrics, the age range, the name of an unknown value.
PLAY_BUCKETS = ["num_25", "num_50", "num_75", "num_985", "num_100"]
LOG_METRICS = ["total_secs", "num_unq", *PLAY_BUCKETS]

AGE_MIN, AGE_MAX = 10, 100
UNKNOWN = "unknown"

# The default tiered contact policy.
POLICY = {
    "policy_name": "tiered_roi_threshold_primary",
    "version": "v2",
    "tiers": [
        {"action": "contact_now", "min_score": 0.68, "channel": "personal outreach with retention incentive",
         "cost_per_contact": 5.0, "assumed_save_rate": 0.2},
        {"action": "nudge", "min_score": 0.2058, "channel": "low-cost email or in-app nudge",
         "cost_per_contact": 0.5, "assumed_save_rate": 0.12},
        {"action": "monitor", "min_score": 0.0, "channel": "none; re-score next cycle",
         "cost_per_contact": 0.0, "assumed_save_rate": 0.0},
    ],
    "value_per_save": 120.0,
    "validation_summary": {
        "valid_rows": 193205,
        "churners": 2402,
        "tier_counts": {"contact_now": 1478, "nudge": 8522, "monitor": 183205},
        "tier_churners": {"contact_now": 1044, "nudge": 757, "monitor": 601},
        "net_per_cycle": {"threshold_only": 17666.0, "top_10k_single_channel": -6776.0, "tiered": 24306.0},
    },
}

# Default economics, capacities and monitoring bands.
VALUE_PER_SAVE, COST_PER_CONTACT, SAVE_RATE = 120.0, 5.0, 0.2
TOP_KS = (5_000, 10_000, 20_000)
OPS_K = 10_000
OPS_CUTOFF = 0.2058
DEFAULT_THRESHOLD = 0.68
PSI_STABLE, PSI_SHIFT, PSI_MIN_ROWS = 0.1, 0.25, 1000
SCENARIOS = {
    "offer": {"value_per_save": 60.0, "cost_per_contact": 10.0, "save_rate": 0.20},
    "outreach": {"value_per_save": 80.0, "cost_per_contact": 0.50, "save_rate": 0.12},
}
# Published holdout figures used by the lift and economics checks.
HOLDOUT = {"valid_churn_rate": 0.012432390465049041, "pr_auc": 0.5392, "precision_at_5000": 0.269,
           "precision_at_10000": 0.1801}
DOCUMENTED_LIFT = {"pr_auc": 43.4, "precision_at_5000": 21.6, "precision_at_10000": 14.5}
# Operating curve (k, tp) of the holdout.
HOLDOUT_CURVE = [(0, 0), (1262, 992), (1478, 1044), (5000, 1345), (10000, 1801), (20000, 2179), (193205, 2402)]
