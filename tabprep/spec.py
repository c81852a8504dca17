"""Feature specifications and the fixed values that must equal the original
toolkit's for the same results.

Operators never name a business column; a ``FeatureSpec`` configures them.
``ACCOUNT_SPEC`` is the configuration of the original study, and
``PROFILE_SPEC`` the one used on the derived ``customer_profile`` table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the original study's for parity; do not edit).
# ---------------------------------------------------------------------------
# Age bins, right-closed, lowest included.
AGE_EDGES = [18, 30, 40, 50, 60, 100]
AGE_LABELS = ["18-30", "30-40", "40-50", "50-60", "60+"]
# Credit score bins, right-closed, lowest included; the last label names (800, 900].
CREDIT_EDGES = [0, 300, 600, 700, 800, 900]
CREDIT_LABELS = ["0-300", "300-600", "600-700", "700-800", "900+"]
# Dashboard age groups, left-closed.
AGE_GROUP_EDGES = [18, 30, 40, 50, 60, 100]
# Category map with default -1 for unmapped values.
GENDER_MAP = {"Female": 0, "Male": 1}
GENDER_DEFAULT = -1
# Label display names; other values map to NULL.
LABEL_NAMES = {0: "Stayed", 1: "Churned"}
# Ratio epsilon added to the denominator.
RATIO_EPS = 1e-6
# Risk tiers on probability x 100: > 70 High, > 40 Medium, else Low.
RISK_CUTS = ((70.0, "High"), (40.0, "Medium"))
RISK_DEFAULT = "Low"
RISK_LABELS = {1: "HIGH RISK", 0: "LOW RISK"}
# Model-name suffixes stripped for display.
MODEL_SUFFIXES = ["_tuned_optuna", "_baseline"]
# Generalisation (CV vs test) classes: both diffs < 0.02, both < 0.05, else.
STABILITY_CUTS = ((0.02, "excellent"), (0.05, "good"))
STABILITY_DEFAULT = "overfit"
# Quality classes on F1: > 0.85, > 0.80, > 0.75, else.
QUALITY_CUTS = ((0.85, "excellent"), (0.80, "good"), (0.75, "acceptable"))
QUALITY_DEFAULT = "poor"
# Tuning verdict: delta > 0 improved; |delta| < 0.005 minimal; else worse.
VERDICT_MINIMAL = 0.005
# IQR multiplier, correlation threshold, folds, test share, seed, k.
IQR_MULTIPLIER = 1.5
CORR_THRESHOLD = 0.95
N_FOLDS = 5
TEST_SIZE = 0.2
SEED = 42
SMOTE_K = 5
CLEAN_K = 3
QUANTILE_MAX_KNOTS = 1000
# Search space of the first learner: whole numbers even, decimals log-even.
SEARCH_SPACE = {
    "n_estimators": {"low": 100, "high": 300},
    "max_depth": {"low": 3, "high": 6},
    "learning_rate": {"low": 0.03, "high": 0.1},
    "subsample": {"low": 0.7, "high": 1.0},
    "colsample_bytree": {"low": 0.7, "high": 1.0},
}
N_TRIALS = 20
# ---------------------------------------------------------------------------


@dataclass
class BinSpec:
    column: str
    edges: list
    labels: list | None = None
    right: bool = True
    include_lowest: bool = True
    out: str | None = None


@dataclass
class FeatureSpec:
    key: str
    target: str
    numeric: list = field(default_factory=list)
    categorical: list = field(default_factory=list)
    bins: list = field(default_factory=list)            # BinSpec
    ratios: list = field(default_factory=list)          # (num, den, out)
    crosses: list = field(default_factory=list)         # (a, b, out)
    sums: list = field(default_factory=list)            # ([cols], out)
    number_crosses: list = field(default_factory=list)  # (num, text, out)
    yeo_johnson: list = field(default_factory=list)
    box_cox: list = field(default_factory=list)
    quantile: list = field(default_factory=list)
    standard: list = field(default_factory=list)
    value_maps: dict = field(default_factory=dict)      # col -> (mapping, default)
    onehot: list = field(default_factory=list)


ACCOUNT_SPEC = FeatureSpec(
    key="CustomerId", target="Exited",
    numeric=["CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "HasCrCard",
             "IsActiveMember", "EstimatedSalary"],
    categorical=["Geography", "Gender"],
    bins=[BinSpec("Age", AGE_EDGES, AGE_LABELS, out="Age_Category"),
          BinSpec("CreditScore", CREDIT_EDGES, CREDIT_LABELS, out="Credit_Score_Range")],
    ratios=[("Balance", "EstimatedSalary", "Balance_Salary_Ratio")],
    crosses=[("Geography", "Gender", "Geo_Gender")],
    sums=[(["NumOfProducts", "HasCrCard"], "Total_Products_Used")],
    number_crosses=[("Total_Products_Used", "Gender", "Tp_Gender")],
    yeo_johnson=["Age"], box_cox=["CreditScore"],
    quantile=["Balance", "EstimatedSalary", "Balance_Salary_Ratio"], standard=["Tenure"],
    value_maps={"Gender": (GENDER_MAP, GENDER_DEFAULT)},
    onehot=["Geography", "Age_Category", "Credit_Score_Range", "Geo_Gender", "Tp_Gender"],
)

PROFILE_SPEC = FeatureSpec(
    key="c_custkey", target="churned",
    numeric=["balance", "n_orders", "total_spend", "has_urgent"],
    categorical=["geography", "segment"],
    bins=[BinSpec("n_orders", [0, 5, 10, 15, 20, 100], out="orders_band"),
          BinSpec("balance", [-1000, 0, 2500, 5000, 7500, 10000], out="balance_band")],
    ratios=[("total_spend", "n_orders", "spend_per_order")],
    crosses=[("geography", "segment", "geo_segment")],
    sums=[(["n_orders", "has_urgent"], "activity")],
    number_crosses=[("activity", "segment", "activity_segment")],
    yeo_johnson=["balance"], box_cox=["total_spend"],
    quantile=["spend_per_order"], standard=["n_orders"],
    onehot=["geography", "segment", "orders_band"],
)
