"""Model evaluation on prediction frames.

All metrics are relational: a prediction frame is any DataFrame with a label,
a 0/1 prediction and (for AUC) a score, so the same operators serve MLlib
output and a rule-based score.  Confusion counts are one pass of four
``count_if`` (the study: four jobs).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.columns import qcol
from riskframe.functions.panel import LABEL
from riskframe.operators._agg import pct
from riskframe.session import materialize


def confusion_counts(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    y, p = qcol(label), qcol(prediction)
    return pred.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                    F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"))


def confusion_report(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """TP, FP, TN, FN, sensitivity, specificity (0 when undefined)."""
    c = confusion_counts(pred, label, prediction)
    return c.select("*", F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0)).alias("sensitivity"),
                    F.coalesce(F.try_divide(F.col("tn"), F.col("tn") + F.col("fp")), F.lit(0.0)).alias("specificity"))


def _weighted(c: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    p1, r1 = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)), F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    p0, r0 = F.coalesce(F.try_divide(tn, tn + fn), F.lit(0.0)), F.coalesce(F.try_divide(tn, tn + fp), F.lit(0.0))
    f1_1 = F.coalesce(F.try_divide(2 * p1 * r1, p1 + r1), F.lit(0.0))
    f1_0 = F.coalesce(F.try_divide(2 * p0 * r0, p0 + r0), F.lit(0.0))
    w1, w0 = F.try_divide(tp + fn, n), F.try_divide(tn + fp, n)
    return c.select(F.try_divide(tp + tn, n).alias("accuracy"), (w0 * p0 + w1 * p1).alias("weighted_precision"),
                    (w0 * r0 + w1 * r1).alias("weighted_recall"), (w0 * f1_0 + w1 * f1_1).alias("f1"))


def auc(pred: DataFrame, label: str = LABEL, score: str = "score", buckets: int | None = None) -> DataFrame:
    """Tie-aware ROC AUC = sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N).

    Distributed and exact: rows collapse to one row per distinct score (so a hot score
    is one row), which are range-partitioned by score: Spark samples the bounds, so
    buckets hold about as many rows each, however the scores are spread.  The bucketed
    rows are materialised; bucket totals (one row a partition) give each bucket's
    offset, and running sums are windows partitioned by bucket.  Numerator kept in
    integers (x2) so the result is exact in any engine."""
    y, s = qcol(label), qcol(score).cast("double")
    per = pred.where(s.isNotNull()).groupBy(s.alias("s")).agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    dealt = per.repartitionByRange(buckets, "s") if buckets else per.repartitionByRange("s")
    per = materialize(dealt.withColumn("b", F.spark_partition_id()))
    up_to = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.groupBy("b").agg(F.sum("neg").alias("bneg")).withColumn("off", F.coalesce(F.sum("bneg").over(up_to), F.lit(0)))
    w = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    within = per.withColumn("below_in", F.coalesce(F.sum("neg").over(w), F.lit(0)))
    j = within.join(offs.select("b", "off"), "b")
    num2 = F.sum(F.col("pos") * (2 * (F.col("off") + F.col("below_in")) + F.col("neg")))
    return j.agg(num2.alias("num2"), F.sum("pos").alias("P"), F.sum("neg").alias("N")).select(
        F.try_divide(F.col("num2").cast("double"), (F.col("P") * F.col("N") * 2).cast("double")).alias("auc"))


def classification_metrics(pred: DataFrame, label: str = LABEL, prediction: str = "prediction",
                           score: str | None = "score") -> DataFrame:
    """G14 relational form: accuracy, weighted precision / recall / F1 (class
    metrics weighted by class size, as MLlib's evaluator) and AUC."""
    m = _weighted(confusion_counts(pred, label, prediction))
    if score is not None:
        m = m.withColumn("auc", F.lit(auc(pred, label, score).first()[0]).cast("double"))
    return m


def grade(auc_col: Column) -> Column:
    """>= .85 Excellent, >= .75 Good, >= .65 Fair, else Poor."""
    return (F.when(auc_col >= 0.85, "Excellent").when(auc_col >= 0.75, "Good").when(auc_col >= 0.65, "Fair")
            .otherwise("Poor"))


def grade_models(metrics: DataFrame, auc_col: str = "auc", model_col: str = "model", chosen_on: DataFrame | None = None) -> DataFrame:
    """Grade per model and a flag on the best model by AUC: that of ``chosen_on`` (the same models'
    metrics on the validation split), so that the rows graded had no say in the choice."""
    best = (chosen_on if chosen_on is not None else metrics).agg(F.max_by(model_col, auc_col)).first()[0]
    return metrics.withColumn("grade", grade(F.col(auc_col))).withColumn("is_best", F.col(model_col) == best)


def confidence_report(pred: DataFrame, prediction: str = "prediction", prob_default: str = "prob_default") -> DataFrame:
    """Per predicted class -- rows, high (> .8) and medium (.6, .8]
    confidence counts, mean confidence (probability of the predicted class)."""
    p = qcol(prediction)
    conf = F.when(p == 1, qcol(prob_default)).otherwise(1 - qcol(prob_default))
    return pred.groupBy(p.alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(conf > 0.8).alias("high_confidence"),
        F.count_if((conf > 0.6) & (conf <= 0.8)).alias("medium_confidence"),
        F.avg(conf).alias("mean_confidence"))


def group_performance(pred: DataFrame, group: str, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Per group -- total, actual and predicted defaults and rates."""
    y, p = qcol(label), qcol(prediction)
    return pred.groupBy(qcol(group)).agg(
        F.count(F.lit(1)).alias("total"), F.sum(y).alias("actual_defaults"), F.sum(p).alias("predicted_defaults"),
        F.avg(y).alias("actual_default_rate"), F.avg(p).alias("predicted_default_rate"))


def segment_performance(pred: DataFrame, segment: str = "CUSTOMER_SEGMENT", label: str = LABEL,
                        prediction: str = "prediction") -> DataFrame:
    """Per segment -- customers, actual / predicted rate %, status on the
    actual rate (< 15 Healthy, < 30 Monitor, else Alert)."""
    out = pred.groupBy(qcol(segment)).agg(
        F.count(F.lit(1)).alias("total_customers"), (F.avg(qcol(label)) * 100).alias("actual_default_rate"),
        (F.avg(qcol(prediction)) * 100).alias("predicted_default_rate"))
    r = F.col("actual_default_rate")
    return out.withColumn("status", F.when(r < 15, "Healthy").when(r < 30, "Monitor").otherwise("Alert"))


def risk_distribution(pred: DataFrame, group: str = "RISK_SCORE_CATEGORY", label: str = LABEL) -> DataFrame:
    """Pivot-rate table with a risk level on the default rate
    (< 10 Low, < 25 Medium, < 40 High, else Critical)."""
    from riskframe.operators.stats import pivot_rate
    r = F.col("default_rate")
    return pivot_rate(pred, group, label).withColumn(
        "risk_level", F.when(r < 10, "Low").when(r < 25, "Medium").when(r < 40, "High").otherwise("Critical"))


def intervention_value(pred: DataFrame, label: str = LABEL, prediction: str = "prediction",
                       loss: float = 50000.0, cost: float = 500.0, success: float = 0.3, by: str | None = None) -> DataFrame:
    """Value of intervening on predicted defaults, optionally per segment.
    prevented = TP x success; gross = prevented x loss; cost = (TP + FP) x cost;
    net = gross - cost; missed = FN x success x loss; ROI % = net / cost x 100."""
    y, p = qcol(label), qcol(prediction)
    keys = [qcol(by)] if by else []
    c = pred.groupBy(*keys).agg(F.count_if((y == 1) & (p == 1)).alias("tp"),
                                F.count_if((y == 0) & (p == 1)).alias("fp"),
                                F.count_if((y == 1) & (p == 0)).alias("fn"))
    prevented = F.col("tp") * success
    gross = prevented * loss
    costs = (F.col("tp") + F.col("fp")) * cost
    net = gross - costs
    return c.select(*([by] if by else []), "tp", "fp", "fn", prevented.alias("defaults_prevented"),
                    gross.alias("gross_savings"), costs.alias("intervention_costs"), net.alias("net_savings"),
                    (F.col("fn") * success * loss).alias("missed_savings"),
                    F.coalesce(pct(net, costs), F.lit(0.0)).alias("roi_pct"))


def score_as_model(df: DataFrame, score: str = "TEMPORAL_RISK_SCORE", threshold: float = 0.5) -> DataFrame:
    """A rule-based 'model': score column as P(default), prediction = score >= t."""
    s = qcol(score)
    return df.withColumns({"score": s, "prediction": F.when(s >= threshold, 1.0).otherwise(0.0),
                           "prob_default": s})
