"""Exploration phase: the study's first-look reports as one dict of lazy
DataFrames (each one job or less when collected)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe.functions.panel import (DEFAULT_PANEL, EDUCATION_LABELS, LABEL, MARRIAGE_LABELS, SEX_LABELS,
                                       PeriodPanel)
from riskframe.operators import profile as P
from riskframe.operators import stats as S


def explore(df: DataFrame, label: str = LABEL, panel: PeriodPanel = DEFAULT_PANEL, accuracy: int | None = 10000) -> dict:
    cols = set(df.columns)
    status = panel.available(df.columns, "status")
    bills, paid = panel.available(df.columns, "bill"), panel.available(df.columns, "paid")
    out = {
        "shape": P.table_shape(df),
        "profile": P.profile(df),
        "class_balance": S.class_balance(df, label),
        "correlations": S.label_correlations(df, label=label),
    }
    for col, labels in (("SEX", SEX_LABELS), ("EDUCATION", EDUCATION_LABELS), ("MARRIAGE", MARRIAGE_LABELS)):
        if col in cols:
            out[f"{col.lower()}_distribution"] = S.distribution(df, col, labels)
            out[f"{col.lower()}_rate"] = S.rate_by(df, col, label)
    if panel.limit in cols:
        out["limit_stats"] = S.numeric_stats(df, [panel.limit], accuracy)
        out["limit_bands"] = S.band_report(df, panel.limit, S.LIMIT_BANDS, S.LIMIT_BANDS_ELSE)
    if panel.age in cols:
        out["age_stats"] = S.numeric_stats(df, [panel.age], accuracy)
        out["age_bands"] = S.band_report(df, panel.age, S.AGE_BANDS, S.AGE_BANDS_ELSE)
    if status:
        out["status_distribution"] = S.period_distribution(df, panel)
        out["status_stats"] = S.period_stats(df, status, accuracy)
        out["status_patterns"] = S.panel_pattern_counts(df, status)
    if bills or paid:
        out["amount_stats"] = S.period_stats(df, list(reversed(bills)) + list(reversed(paid)), accuracy)
    if bills and paid:
        out["efficiency"] = S.period_efficiency(df, panel, accuracy)
        out["zero_payments"] = S.zero_payments(df, list(reversed(paid)))
    if "BILL_AMT1" in cols and panel.limit in cols:
        out["utilisation"] = S.utilisation(df, "BILL_AMT1", panel.limit)
    return out
