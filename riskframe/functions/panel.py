"""Period panel configuration and the fixed code lists of the data model.

Six monthly observations are stored *wide*.  Index 1 (or PAY_0) is the latest
month, 6 the oldest; there is no PAY_1.  The panel lists columns oldest -> newest,
which is the order every row-wise feature folds over.
"""

from __future__ import annotations

from dataclasses import dataclass, field

LABEL = "default_next_month"

# ---- fixed values (must equal the data dictionary of the source study) ----
STATUS_CODES = [-2, -1, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9]
STATUS_MEANINGS = {
    -2: "No consumption",
    -1: "Pay duly",
    0: "Use of revolving credit",
    1: "Payment delay for one month",
    2: "Payment delay for two months",
    3: "Payment delay for three months",
    4: "Payment delay for four months",
    5: "Payment delay for five months",
    6: "Payment delay for six months",
    7: "Payment delay for seven months",
    8: "Payment delay for eight months",
    9: "Payment delay for nine months and above",
}
SEX_LABELS = {1: "Male", 2: "Female"}
EDUCATION_LABELS = {1: "Graduate School", 2: "University", 3: "High School", 4: "Others"}
MARRIAGE_LABELS = {1: "Married", 2: "Single", 3: "Others"}
VARIABLE_IDS = {
    "LIMIT_BAL": "X1", "SEX": "X2", "EDUCATION": "X3", "MARRIAGE": "X4", "AGE": "X5",
    "PAY_0": "X6", "PAY_2": "X7", "PAY_3": "X8", "PAY_4": "X9", "PAY_5": "X10", "PAY_6": "X11",
    "BILL_AMT1": "X12", "BILL_AMT2": "X13", "BILL_AMT3": "X14",
    "BILL_AMT4": "X15", "BILL_AMT5": "X16", "BILL_AMT6": "X17",
    "PAY_AMT1": "X18", "PAY_AMT2": "X19", "PAY_AMT3": "X20",
    "PAY_AMT4": "X21", "PAY_AMT5": "X22", "PAY_AMT6": "X23",
}
VARIABLE_GROUPS = [  # of X1..X23, by the last id of each group
    (5, "Demographics"), (11, "Payment History"), (17, "Bill Statements"), (23, "Payment Amounts"),
]
# ---- end of fixed values ----

DEMOGRAPHIC_COLS = ["LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE"]
CATEGORICAL_CODE_COLS = ["SEX", "EDUCATION", "MARRIAGE"]
# ---- fixed values: the study's feature categories ----
FEATURE_CATEGORIES = {
    "Payment Trends": ["PAYMENT_TREND_SLOPE", "PAYMENT_STATUS_VOLATILITY", "MAX_PAYMENT_DELAY",
                       "MIN_PAYMENT_DELAY", "PAYMENT_DELAY_RANGE"],
    "Temporal Segmentation": ["RECENT_AVG_DELAY", "HISTORICAL_AVG_DELAY", "PAYMENT_IMPROVEMENT_SCORE",
                              "RECOVERY_INSTANCES"],
    "Financial Analysis": ["BILL_TREND_SLOPE", "BILL_AMOUNT_VOLATILITY", "DEBT_ACCUMULATION_RATE",
                           "AVG_BILL_AMOUNT"],
    "Payment Efficiency": ["AVG_PAYMENT_EFFICIENCY", "PAYMENT_EFFICIENCY_TREND", "PAYMENT_CONSISTENCY_SCORE",
                           "AVG_PAYMENT_AMOUNT"],
    "Credit Utilization": ["CREDIT_UTILIZATION_RATIO", "CREDIT_BUFFER", "CREDIT_UTILIZATION_TREND"],
    "Behavioral Classification": ["PAYMENT_BEHAVIOR_TYPE", "TEMPORAL_RISK_LEVEL", "CUSTOMER_SEGMENT"],
    "Risk Scoring": ["TEMPORAL_RISK_SCORE", "RISK_SCORE_CATEGORY"],
}
# ---- end of fixed values ----
# ---- fixed values: categories by name; a column belongs to every category one of whose terms it meets ----
FEATURE_NAME_RULES = [
    ("Payment Trends", "contains", ("TREND", "VOLATILITY", "DELAY")),
    ("Temporal Segmentation", "contains", ("RECENT", "HISTORICAL", "IMPROVEMENT", "RECOVERY")),
    ("Financial Analysis", "contains", ("BILL", "DEBT", "AVG_BILL")),
    ("Payment Efficiency", "contains", ("EFFICIENCY", "CONSISTENCY", "AVG_PAYMENT")),
    ("Credit Utilization", "contains", ("CREDIT", "UTILIZATION", "BUFFER")),
    ("Behavioral Classification", "contains", ("BEHAVIOR", "SEGMENT", "RISK")),
]
MODEL_NAME_RULES = [
    ("Demographics", "in", ("LIMIT_BAL", "AGE")),
    ("Payment Status", "startswith", ("PAY_",)),
    ("Financial", "startswith", ("BILL_AMT", "PAY_AMT")),
    ("Temporal Features", "contains", ("TREND", "IMPROVEMENT", "VOLATILITY", "RECOVERY", "RECENT", "HISTORICAL")),
    ("Credit Features", "contains", ("CREDIT", "UTILIZATION", "EFFICIENCY", "CONSISTENCY")),
    ("Risk Features", "contains", ("RISK",)),
    ("Categorical", "in", ("SEX", "EDUCATION", "MARRIAGE", "PAYMENT_BEHAVIOR_TYPE", "TEMPORAL_RISK_LEVEL", "CUSTOMER_SEGMENT", "RISK_SCORE_CATEGORY")),
]
# Importance labels of features that the variable dictionary does not hold; the first that is met counts.
IMPORTANCE_LABELS = [
    ("Temporal", "contains", ("TREND", "IMPROVEMENT", "VOLATILITY")),
    ("Credit", "contains", ("CREDIT", "UTILIZATION", "EFFICIENCY")),
    ("Risk", "contains", ("RISK",)),
]
GROUP_LABELS = {"Bill Statements": "Bills", "Payment Amounts": "Payments"}  # as importance reports name them
# ---- end of fixed values ----
CATEGORICAL_FEATURES = ["PAYMENT_BEHAVIOR_TYPE", "TEMPORAL_RISK_LEVEL", "CUSTOMER_SEGMENT", "RISK_SCORE_CATEGORY"]


@dataclass(frozen=True)
class PeriodPanel:
    """Wide monthly panel. All lists run oldest -> newest; ``months`` gives the
    month number of each position (6 = oldest ... 1 = latest)."""

    status: tuple = ("PAY_6", "PAY_5", "PAY_4", "PAY_3", "PAY_2", "PAY_0")
    bill: tuple = ("BILL_AMT6", "BILL_AMT5", "BILL_AMT4", "BILL_AMT3", "BILL_AMT2", "BILL_AMT1")
    paid: tuple = ("PAY_AMT6", "PAY_AMT5", "PAY_AMT4", "PAY_AMT3", "PAY_AMT2", "PAY_AMT1")
    months: tuple = (6, 5, 4, 3, 2, 1)
    limit: str = "LIMIT_BAL"
    age: str = "AGE"
    recent: int = field(default=3)

    def available(self, columns, which: str) -> list:
        cols = set(columns)
        return [c for c in getattr(self, which) if c in cols]

    def by_month(self, columns, which: str) -> dict:
        cols = set(columns)
        return {m: c for m, c in zip(self.months, getattr(self, which)) if c in cols}

    def money(self) -> list:
        """Money columns in the order the cleaning steps visit them."""
        return [self.limit] + list(reversed(self.bill)) + list(reversed(self.paid))

    def all_columns(self) -> list:
        return [self.limit, self.age, *self.status, *self.bill, *self.paid]


DEFAULT_PANEL = PeriodPanel()
