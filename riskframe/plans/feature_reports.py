"""Feature-analysis phase: band reports, percentiles and label means of the
engineered features (F1-F12, D15, D17, B15)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe.functions.panel import LABEL
from riskframe.operators import bands as B
from riskframe.operators import profile as P
from riskframe.operators import stats as S
from riskframe.operators.features import FEATURE_NAMES


def feature_reports(feat: DataFrame, label: str = LABEL, accuracy: int | None = 10000) -> dict:
    cols = set(feat.columns)
    out = {f"bands_{c.lower()}": B.feature_band_report(feat, c) for c in B.REPORTS if c in cols}
    for c in ("PAYMENT_BEHAVIOR_TYPE", "RISK_SCORE_CATEGORY", "TEMPORAL_RISK_LEVEL", "CUSTOMER_SEGMENT"):
        if c in cols:
            out[f"classes_{c.lower()}"] = B.class_report(feat, c)
    for c in ("PAYMENT_TREND_SLOPE", "PAYMENT_IMPROVEMENT_SCORE", "AVG_PAYMENT_EFFICIENCY", "CREDIT_UTILIZATION_RATIO",
              "TEMPORAL_RISK_SCORE"):
        if c in cols:
            out[f"percentiles_{c.lower()}"] = S.percentiles(feat, c, accuracy=accuracy)
            if label in cols:
                out[f"by_label_{c.lower()}"] = S.mean_by_label(feat, c, label)
    if "DEBT_ACCUMULATION_RATE" in cols:
        out["debt"] = B.debt_report(feat)
    if {"AVG_BILL_AMOUNT", "LIMIT_BAL"} <= cols:
        out["basic_utilisation"] = B.basic_utilisation_report(feat, accuracy)
    if "CREDIT_BUFFER" in cols:
        out["buffer"] = B.buffer_report(feat, accuracy)
    if label in cols and "RISK_SCORE_CATEGORY" in cols:
        out["risk_category_rate"] = S.pivot_rate(feat, "RISK_SCORE_CATEGORY", label)
    numeric = [c for c in FEATURE_NAMES if c in cols and dict(feat.dtypes)[c] != "string"]
    out["low_variance"] = P.low_variance(feat, numeric)
    out["feature_correlations"] = S.label_correlations(feat, numeric, label, top=None)
    return out
