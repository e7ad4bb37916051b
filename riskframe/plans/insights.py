"""Business insight bundle from one prediction frame.

The study evaluates the test split twice (once inside the insight step); here
predictions are materialised once, and each table is one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe.functions.panel import LABEL
from riskframe.operators import evaluation as E
from riskframe.session import materialize


def business_insights(pred: DataFrame, label: str = LABEL, score: str | None = "score",
                      risk_col: str = "RISK_SCORE_CATEGORY", segment_col: str = "CUSTOMER_SEGMENT") -> dict:
    pred = materialize(pred)
    out = {
        "confusion": E.confusion_report(pred, label),
        "metrics": E.classification_metrics(pred, label, score=score),
        "value": E.intervention_value(pred, label),
    }
    if risk_col in pred.columns:
        out["risk_distribution"] = E.risk_distribution(pred, risk_col, label)
        out["risk_performance"] = E.group_performance(pred, risk_col, label)
    if segment_col in pred.columns:
        out["segments"] = E.segment_performance(pred, segment_col, label)
    return out
