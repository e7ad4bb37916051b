"""Feature banding reports (F1-F12): ``ladder`` + ``distribution``.

Each report is one grouped count over a projected band label; the % total is a
scalar subquery.  Labels are parameters: the defaults are the study's labels
(including its inverted trend wording, Q5); ``CORRECTED_TREND_LABELS`` is
offered for the slope sign as computed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import qcol
from riskframe.operators.selection import percentile_columns
from riskframe.operators.stats import band_report, distribution, percentiles, threshold_count
from riskframe.operators._agg import pct

# ---- fixed values: band ladders of the source study, top-down, then "else" ----
TREND_BANDS = ([(">", 1, "Strongly Improving"), (">", 0.2, "Improving"), (">", -0.2, "Stable"),
                (">", -1, "Deteriorating")], "Strongly Deteriorating")
CORRECTED_TREND_LABELS = ([(">", 1, "Strongly Deteriorating"), (">", 0.2, "Deteriorating"), (">", -0.2, "Stable"),
                           (">", -1, "Improving")], "Strongly Improving")
IMPROVEMENT_BANDS = ([(">", 2, "Significant Improvement"), (">", 0.5, "Moderate Improvement"), (">", -0.5, "Stable"),
                      (">", -2, "Moderate Deterioration")], "Significant Deterioration")
RECOVERY_BANDS = ([("==", 0, "No recovery"), ("<=", 2, "Limited recovery"), ("<=", 4, "Good recovery")],
                  "Excellent recovery")
BILL_TREND_BANDS = ([(">", 5000, "Rapidly Increasing"), (">", 1000, "Increasing"), (">", -1000, "Stable"),
                     (">", -5000, "Decreasing")], "Rapidly Decreasing")
EFFICIENCY_BANDS = ([(">=", 1.0, "Full Payment"), (">=", 0.8, "High Efficiency"), (">=", 0.5, "Medium Efficiency"),
                     (">=", 0.2, "Low Efficiency")], "Very Low Efficiency")
EFFICIENCY_TREND_BANDS = ([(">", 0.1, "Improving Efficiency"), (">", -0.1, "Stable Efficiency")],
                          "Declining Efficiency")
UTILISATION_BANDS = ([("<=", 0.1, "Very Low (≤10%)"), ("<=", 0.3, "Low (10-30%)"), ("<=", 0.5, "Medium (30-50%)"),
                      ("<=", 0.8, "High (50-80%)"), ("<=", 1.0, "Very High (80-100%)")], "Over Limit (>100%)")
UTILISATION_TREND_BANDS = ([(">", 0.1, "Increasing Utilization"), (">", -0.1, "Stable Utilization")],
                           "Decreasing Utilization")
HIGH_DEBT, DEBT_REDUCTION, HIGH_UTILISATION, LOW_BUFFER = 0.5, -0.1, 0.8, 10000
# ---- end of fixed values ----

REPORTS = {
    "PAYMENT_TREND_SLOPE": TREND_BANDS,
    "PAYMENT_IMPROVEMENT_SCORE": IMPROVEMENT_BANDS,
    "RECOVERY_INSTANCES": RECOVERY_BANDS,
    "BILL_TREND_SLOPE": BILL_TREND_BANDS,
    "AVG_PAYMENT_EFFICIENCY": EFFICIENCY_BANDS,
    "PAYMENT_EFFICIENCY_TREND": EFFICIENCY_TREND_BANDS,
    "CREDIT_UTILIZATION_RATIO": UTILISATION_BANDS,
    "CREDIT_UTILIZATION_TREND": UTILISATION_TREND_BANDS,
}


def feature_band_report(df: DataFrame, feature: str, bands=None) -> DataFrame:
    """(band, count, pct) for one feature."""
    steps, otherwise = bands or REPORTS[feature]
    return band_report(df, feature, steps, otherwise)


def debt_report(df: DataFrame) -> DataFrame:
    """customers with debt rate > 0.5 and < -0.1 (one pass)."""
    d = F.col("DEBT_ACCUMULATION_RATE")
    return df.agg(F.count_if(d > HIGH_DEBT).alias("high_debt"), F.count_if(d < DEBT_REDUCTION).alias("debt_reduction"),
                  F.count(F.lit(1)).alias("n")).select(
        "high_debt", pct(F.col("high_debt"), F.col("n")).alias("high_debt_pct"),
        "debt_reduction", pct(F.col("debt_reduction"), F.col("n")).alias("debt_reduction_pct"))


def basic_utilisation_report(df: DataFrame, accuracy: int | None = 10000) -> DataFrame:
    """mean / median / p90 of avg bill / limit (0 if limit <= 0), count > 0.8."""
    lim, avg_bill = qcol("LIMIT_BAL"), F.col("AVG_BILL_AMOUNT")
    u = F.when(lim > 0, avg_bill / lim).otherwise(0)
    median, p90 = percentile_columns(df, {"u": (u, [0.5, 0.9])}, accuracy)["u"]
    return df.agg(F.avg(u).alias("avg_util"), median.alias("median_util"), p90.alias("p90_util"),
                  F.count_if((lim > 0) & (F.try_divide(avg_bill, lim) > HIGH_UTILISATION)).alias("high_util"))


def buffer_report(df: DataFrame, accuracy: int | None = 10000) -> DataFrame:
    """credit buffer mean and quartiles, count below 10,000."""
    b = F.col("CREDIT_BUFFER")
    q1, median, q3 = percentile_columns(df, {"b": (b, [0.25, 0.5, 0.75])}, accuracy)["b"]
    return df.agg(F.avg(b).alias("avg_buffer"), q1.alias("q1"), median.alias("median"), q3.alias("q3"),
                  F.count_if(b < LOW_BUFFER).alias("low_buffer"))


def class_report(df: DataFrame, feature: str) -> DataFrame:
    """distribution of a class column (behaviour type, risk category)."""
    return distribution(df, feature, name="band")


__all__ = ["feature_band_report", "debt_report", "basic_utilisation_report", "buffer_report", "class_report",
           "percentiles", "threshold_count", "REPORTS"]
