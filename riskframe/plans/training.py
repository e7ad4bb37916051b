"""Model phase: split -> preprocessing fitted on train -> models (optionally
cross-validated) -> evaluation, grades, importances, probabilities and the
business tables on the best model's test predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.panel import LABEL
from riskframe.operators import evaluation as E
from riskframe.operators import ml as M
from riskframe.plans.insights import business_insights
from riskframe.session import materialize


#: Column that marks the validation rows of the training frame.
VALIDATION = "_is_validation"


def train_and_evaluate(feat: DataFrame, label: str = LABEL, key: str | None = "ID", method: str = "all",
                       models: dict | None = None, tune: bool = False, folds: int = 3, parallelism: int = 4) -> dict:
    """The validation split stops boosting early and chooses the best model; the test split is read for the
    figures that are reported, and by nothing that is fitted or chosen."""
    feat = materialize(feat)  # phase hand-off: several passes read it
    train, val, test = M.split_data(feat, key=key)
    num, cat = M.prepare_features(feat, label, method)
    prep, names = M.fit_preprocessing(train, num, cat)
    fitting = prep.transform(M.dealt(train))
    if tune and key:
        fitting = M.with_folds(fitting, key, folds)
    fitting, val_p, test_p = materialize(fitting), materialize(prep.transform(val)), materialize(prep.transform(test))
    marked = fitting.withColumn(VALIDATION, F.lit(False)).unionByName(val_p.withColumn(VALIDATION, F.lit(True)), allowMissingColumns=True)
    zoo = models or M.model_zoo(label, len(names), validation=None if tune else VALIDATION)
    ms = M.train_models(marked, zoo, label, tune=tune, folds=folds, parallelism=parallelism, fold_col="fold" if tune and key else None,
                        validation=VALIDATION, together=2)
    on_val = M.evaluate_models(ms, val_p, label)
    metrics = E.grade_models(M.evaluate_models(ms, test_p, label), chosen_on=on_val)
    out = {"split": M.split_report(feat, key, label) if key else None, "metrics": metrics, "validation_metrics": on_val, "models": ms,
           "preprocessing": prep, "feature_names": names,
           "skipped_rows": M.skipped_rows({"train": train, "validation": val, "test": test}, num)}
    if tune:
        out["candidates"] = M.candidate_metrics(ms, feat.sparkSession)
    imps = [M.feature_importance(m, names, n, feat.sparkSession) for n, m in ms.models.items()
            if hasattr(m, "featureImportances")]
    if imps:
        allimp = imps[0]
        for i in imps[1:]:
            allimp = allimp.unionByName(i)
        out["importance"] = allimp
        out["importance_by_category"] = M.importance_by_category(allimp)
        out["importance_comparison"] = M.compare_importance(allimp, [n for n, m in ms.models.items()
                                                                       if hasattr(m, "featureImportances")])
    scored = metrics.where("auc IS NOT NULL")
    if scored.count():
        best = scored.where("is_best").first()["model"]
        pred = M.with_probabilities(ms.models[best].transform(test_p)).withColumn("score", F.col("prob_default"))
        out["best_model"] = best
        out["confidence"] = E.confidence_report(pred)
        out["insights"] = business_insights(pred, label)
    return out
