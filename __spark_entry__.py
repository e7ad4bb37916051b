"""

``entry(spark)`` runs the flagship query on sf0.001; ``queries()`` registers one
Spark query per implemented operator (each reads the driver's parquet tables
and derives the ``accounts`` view from customer / orders / lineitem, so its
work grows with them); ``oracle_sql()`` gives the DuckDB twin of each
relational query.  Fitted models have no SQL twin; ``model_checks`` and
``cross_validated_model`` compare what must hold for any of them.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskframe.functions.columns import qcol  # noqa: E402
from riskframe.functions.dictionary import with_importance_label, with_variables  # noqa: E402
from riskframe.functions.panel import (EDUCATION_LABELS, FEATURE_CATEGORIES, FEATURE_NAME_RULES, LABEL, MARRIAGE_LABELS,  # noqa: E402
                                      MODEL_NAME_RULES, SEX_LABELS, STATUS_CODES, VARIABLE_IDS)
from riskframe.operators import bands as B  # noqa: E402
from riskframe.operators import cleaning as C  # noqa: E402
from riskframe.operators import evaluation as E  # noqa: E402
from riskframe.operators import ml as M  # noqa: E402
from riskframe.operators import profile as P  # noqa: E402
from riskframe.operators import stats as S  # noqa: E402
from riskframe.operators.features import FEATURE_NAMES, all_features  # noqa: E402
from riskframe.plans.cleanse import cleanse  # noqa: E402
from riskframe.plans.insights import business_insights  # noqa: E402
from riskframe.plans.flagship import risk_category_default_rate  # noqa: E402
from riskframe.plans.training import train_and_evaluate  # noqa: E402
from riskframe.session import materialize, shared_path  # noqa: E402
from riskframe.sources.fixtures import accounts, accounts_dirty  # noqa: E402
from riskframe.sources.io import (load_csv, load_fitted, load_table, read_run_metrics, sample_rows, save_fitted,  # noqa: E402
                                  save_table, write_run_metrics)

try:  # the training-data operators are an optional subpackage
    from riskframe.llm import registry as LLM
except ImportError as missing:  # no such folder, or an empty one that has no file to name
    if missing.name != "riskframe.llm" or missing.path:
        raise
    LLM = None

EXACT = None  # exact percentiles, by distributed selection
STATUS = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
BILLS = [f"BILL_AMT{i}" for i in range(1, 7)]
PAYS = [f"PAY_AMT{i}" for i in range(1, 7)]
GONE = ("PAY_6", "PAY_3", "BILL_AMT1", "BILL_AMT5", "PAY_AMT2", "PAY_AMT4")  # a panel with gaps
FEW = tuple(c for c in STATUS + BILLS + PAYS if c not in ("PAY_0", "PAY_5", "BILL_AMT2", "BILL_AMT4"))  # too few months for most features
NUMERIC_FEATURES = ["PAYMENT_TREND_SLOPE", "PAYMENT_STATUS_VOLATILITY", "MAX_PAYMENT_DELAY", "MIN_PAYMENT_DELAY",
                    "PAYMENT_DELAY_RANGE", "RECENT_AVG_DELAY", "HISTORICAL_AVG_DELAY", "PAYMENT_IMPROVEMENT_SCORE",
                    "RECOVERY_INSTANCES", "BILL_TREND_SLOPE", "BILL_AMOUNT_VOLATILITY", "DEBT_ACCUMULATION_RATE",
                    "AVG_BILL_AMOUNT", "AVG_PAYMENT_EFFICIENCY", "PAYMENT_EFFICIENCY_TREND",
                    "PAYMENT_CONSISTENCY_SCORE", "AVG_PAYMENT_AMOUNT", "CREDIT_UTILIZATION_RATIO", "CREDIT_BUFFER",
                    "CREDIT_UTILIZATION_TREND", "TEMPORAL_RISK_SCORE"]


def _acc(spark, sf):
    return accounts(spark, sf)


def _dirty(spark, sf):
    return accounts_dirty(spark, sf)


def _acc_table(spark, sf):
    """The account table materialised once, for operators that read it several times."""
    return materialize(accounts(spark, sf))


def _dirty_table(spark, sf):
    return materialize(accounts_dirty(spark, sf))


def _feat(spark, sf):
    return all_features(accounts(spark, sf))


def _feat_table(spark, sf):
    """Feature table materialised at the phase edge (multi-pass consumers)."""
    return materialize(_feat(spark, sf))


def _pred(spark, sf):
    return E.score_as_model(_feat(spark, sf))


def _round(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(qcol(c), digits) for c in cols})


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: default rate per risk-score category on sf0.001."""
    return risk_category_default_rate(spark, "/root/testdata/sf0.001")


def _fitted(spark, sf, names=None, tune=False):
    """Models at the study's settings on all features, and the prepared splits."""
    feat = _feat_table(spark, sf)
    train, val, test = M.split_data(feat, key="ID")
    num, cat = M.prepare_features(feat, LABEL, method="all")
    prep, columns = M.fit_preprocessing(train, num, cat)
    zoo = {k: v for k, v in M.model_zoo(LABEL, len(columns)).items() if names is None or k in names}
    train_p = materialize(prep.transform(M.dealt(train)).select("scaledFeatures", LABEL))
    return M.train_models(train_p, zoo, LABEL, tune=tune, together=2), columns, prep.transform(val), prep.transform(test)


def _held(split):
    """A held-out split as models read it, materialised once for all of them."""
    return materialize(split.select("scaledFeatures", LABEL))


def _model_evaluation(spark, sf):
    ms, _, _, test = _fitted(spark, sf)
    return E.grade_models(M.evaluate_models(ms, _held(test), LABEL))


def _importances(spark, ms, columns):
    out = None
    for name, model in ms.models.items():
        if hasattr(model, "featureImportances"):
            imp = M.feature_importance(model, columns, name, spark)
            out = imp if out is None else out.unionByName(imp)
    return out


def _importance(spark, sf, by_category=False):
    ms, columns, _, _ = _fitted(spark, sf, ("Random Forest", "Gradient Boosting") if by_category else ("Random Forest",))
    imp = _importances(spark, ms, columns)
    return M.importance_by_category(imp) if by_category else imp


def _importance_comparison(spark, sf):
    ms, columns, _, _ = _fitted(spark, sf, ("Random Forest", "Gradient Boosting"))
    return M.compare_importance(_importances(spark, ms, columns), list(ms.models))


def _model_checks(spark, sf):
    """What holds for any fitted model: a prediction for each row without a NULL
    feature of the held-out splits, probabilities that add up to 1, importances that add
    up to 1, category shares that add up to 100 %."""
    ms, columns, val, test = _fitted(spark, sf)
    imps = _importances(spark, ms, columns)
    out, held = None, {"validation": _held(val), "test": _held(test)}
    for name, model in ms.models.items():
        for split, frame in held.items():
            p = M.with_probabilities(model.transform(frame))
            row = p.agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("prob_default") + F.col("prob_no_default") - 1) < 1e-9).alias("n_sum_1"),
                        F.count_if(F.col("prediction").isin(0.0, 1.0)).alias("n_class"))
            row = row.select(F.lit(name).alias("model"), F.lit(split).alias("split"), "*")
            out = row if out is None else out.unionByName(row)
    sums = imps.groupBy("model").agg(F.round(F.sum("importance"), 6).alias("importance_sum"))
    shares = M.importance_by_category(imps).groupBy("model").agg(F.round(F.sum("pct"), 6).alias("category_pct"))
    return out.join(sums, "model", "left").join(shares, "model", "left")


def _cross_validated(spark, sf):
    """Logistic regression over its whole grid, 3 folds, then the insight tables."""
    ms, _, _, test = _fitted(spark, sf, ("Logistic Regression",), tune=True)
    pred = M.with_probabilities(ms.models["Logistic Regression"].transform(test)).withColumn("score", F.col("prob_default"))
    tables = business_insights(pred, LABEL)
    counts, metrics, risk = tables["confusion"], tables["metrics"], tables["risk_performance"]
    n = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    out = counts.select(n.alias("n_test"), (F.col("tp") + F.col("fn")).alias("n_default"), ((F.col("tp") + F.col("tn")) / n).alias("counted"))
    difference = F.abs(F.round(F.col("counted") - metrics.select("accuracy").scalar(), 9))
    return out.select("n_test", "n_default", difference.alias("accuracy_difference"), risk.agg(F.sum("total")).scalar().alias("n_in_risk_groups"))


def _skipped_rows(spark, sf):
    feat = materialize(all_features(accounts_dirty(spark, sf)))
    num, _ = M.prepare_features(feat, LABEL, method="all")
    return M.skipped_rows(dict(zip(("train", "validation", "test"), M.split_data(feat, key="ID"))), num)


def _cv_folds(spark, sf):
    train, _, _ = M.split_data(_acc(spark, sf), key="ID")
    return M.with_folds(train, "ID").groupBy("fold").agg(F.count("*").alias("n"), F.sum(LABEL).alias("n_default"))


def _grid_candidates(spark, sf, names=("Logistic Regression", "Neural Network")):
    """Every candidate of the grids over folds by md5, and what must hold for them.  The forest's and the
    boosting's grids (13 more candidates) take the same way; they are left out here for their time."""
    feat = _feat_table(spark, sf)
    train, _, _ = M.split_data(feat, key="ID")
    num, cat = M.prepare_features(feat, LABEL, method="all")
    prep, columns = M.fit_preprocessing(train, num, cat)
    fitting = materialize(M.with_folds(prep.transform(M.dealt(train)), "ID").select("scaledFeatures", LABEL, "fold"))
    zoo = {k: v for k, v in M.model_zoo(LABEL, len(columns)).items() if k in names}
    ms = M.train_models(fitting, zoo, LABEL, tune=True, parallelism=8, fold_col="fold")
    of_model = M.candidate_metrics(ms, spark).groupBy("model").agg(
        F.count("*").alias("n_candidates"), F.count_distinct("parameters").alias("n_settings"), F.count_if("chosen").alias("n_chosen"),
        (F.max(F.when(F.col("chosen"), F.col("auc"))) == F.max("auc")).alias("chosen_is_best"), F.count_if(F.col("auc").between(0, 1)).alias("n_auc_in_range"))
    return of_model.select("*", fitting.select(F.count_distinct("fold")).scalar().alias("n_folds"), fitting.select(F.count("*")).scalar().alias("n_train"))


def _model_selection(spark, sf):
    """The model phase: chosen by validation AUC, graded on the test split."""
    out = train_and_evaluate(_feat(spark, sf), LABEL)
    val, test = out["validation_metrics"], out["metrics"]
    best = F.max_by("model", "auc")
    n = {r["split"]: r["n_in"] - r["n_skipped"] for r in out["skipped_rows"].collect()}
    return test.select("model", (F.col("is_best") == (F.col("model") == val.agg(best).scalar())).alias("chosen_on_validation"),
                       (F.col("grade") == E.grade(F.col("auc"))).alias("graded_on_test"),
                       F.lit(n["validation"]).cast("bigint").alias("n_validation"), F.lit(n["test"]).cast("bigint").alias("n_test"))


def _importance_labels(spark, sf):
    ms, columns, _, _ = _fitted(spark, sf, ("Random Forest",))
    labelled = with_importance_label(_importances(spark, ms, columns))
    return labelled.select("feature", "variable", "category", F.col("importance").between(0, 1).alias("in_range"))


def _importance_comparison_checks(spark, sf):
    both = _importance_comparison(spark, sf)
    names = [c for c in both.columns if c != "feature"]
    long = both.select(F.inline(F.array(*[F.struct(F.lit(m).alias("model"), qcol(m).alias("v")) for m in names])))
    return long.groupBy("model").agg(F.count("v").alias("n_features"), F.round(F.sum("v"), 6).alias("importance_sum"))


def _saved_model(spark, sf):
    """Predictions of a fitted model and of the same one read back from its files, row by row."""
    feat = _feat_table(spark, sf)
    train, _, test = M.split_data(feat, key="ID")
    num, cat = M.prepare_features(feat, LABEL, method="all")
    prep, names = M.fit_preprocessing(train, num, cat)
    model = M.train_models(prep.transform(train), {"Logistic Regression": M.model_zoo(LABEL)["Logistic Regression"]}, LABEL).models["Logistic Regression"]
    path = shared_path(spark, "model")
    save_fitted(prep, model, path)
    wanted = ["ID", "prediction", "prob_default"]
    before = M.with_probabilities(model.transform(prep.transform(test))).select(*wanted)
    after = M.with_probabilities(load_fitted(path).transform(test)).select("ID", *[F.col(c).alias(f"{c}_again") for c in wanted[1:]])
    same = (F.col("prediction") == F.col("prediction_again")) & (F.col("prob_default") == F.col("prob_default_again"))
    return before.join(after, "ID", "full").agg(F.count("*").alias("n"), F.count_if(same).alias("n_equal"))


def _parquet_accounts(spark, sf):
    path = shared_path(spark, "accounts")
    save_table(_acc(spark, sf), path)
    return load_table(spark, path, "parquet")


def _csv_parts(spark, sf):
    """Accounts through CSV files with a stated schema; every account with ID % 50 = 7 is written with a text
    where its age belongs."""
    acc, path = _acc(spark, sf), shared_path(spark, "accounts-csv")
    save_table(acc.withColumn("AGE", F.when(F.col("ID") % 50 == 7, "unknown").otherwise(F.col("AGE").cast("string"))), path, "csv")
    return load_csv(spark, path, acc.schema)


def _csv_lines(spark, sf):
    good, bad = _csv_parts(spark, sf)
    bad_ids = bad.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.split_part("line", F.lit(","), F.lit(1)).cast("bigint")), F.lit(0)).alias("ids"))
    return good.agg(F.count("*").alias("n_rows")).select("n_rows", bad_ids.select("n").scalar().alias("n_bad_lines"), bad_ids.select("ids").scalar().alias("bad_ids"))


def _run_metrics(spark, sf):
    """Two runs in the run table, the first written twice."""
    metrics = _round(E.classification_metrics(E.score_as_model(_feat_table(spark, sf))), ["accuracy", "weighted_precision", "weighted_recall", "f1", "auc"], 9)
    path = shared_path(spark, "runs")
    for run in ("001", "second", "001"):
        write_run_metrics(metrics, path, run)
    return read_run_metrics(spark, path).drop("recorded_at")


def _quality_pair(spark, sf, op):
    before = materialize(_dirty(spark, sf))
    after = materialize(cleanse(before, accuracy=EXACT))
    rb, ra = P.quality_report(before), P.quality_report(after)
    if op == "score":
        return P.quality_score(rb, ra, after.columns)
    return op(rb, ra)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    # sources / fixtures / features
    Q["accounts"] = _acc
    Q["accounts_dirty"] = _dirty
    Q["sample_rows"] = lambda s, sf: sample_rows(_acc(s, sf), 200, key="ID")
    Q["features"] = _feat
    Q["risk_category_default_rate"] = risk_category_default_rate
    # profiling
    Q["table_shape"] = lambda s, sf: P.table_shape(_dirty(s, sf))
    Q["null_counts"] = lambda s, sf: P.null_counts(_dirty(s, sf))
    Q["duplicate_count"] = lambda s, sf: P.duplicate_count(_dirty_table(s, sf))
    Q["column_profile"] = lambda s, sf: P.profile(_dirty(s, sf))
    Q["describe_columns"] = lambda s, sf: _round(P.describe_columns(_dirty(s, sf), ["LIMIT_BAL", "AGE", LABEL]),
                                                 ["mean", "stddev"])
    Q["quality_report"] = lambda s, sf: P.quality_report(_dirty_table(s, sf))
    Q["low_variance"] = lambda s, sf: P.low_variance(_feat(s, sf), NUMERIC_FEATURES).select(
        "column_name", "low_variance", F.when(F.col("variance") > 0, F.round(F.log10("variance"), 6)).alias("log10_variance"))
    Q["duplicate_keys"] = lambda s, sf: P.duplicate_keys(_dirty(s, sf), "ID")
    Q["duplicate_key_examples"] = lambda s, sf: P.duplicate_keys(_dirty(s, sf), "ID", n=5)
    Q["contract_violations"] = lambda s, sf: P.contract_violations(_dirty(s, sf), P.default_contract(LABEL))
    Q["profile_by_category"] = lambda s, sf: P.profile_by_category(_feat(s, sf), FEATURE_CATEGORIES)
    Q["sample_values"] = lambda s, sf: P.sample_values(materialize(_dirty(s, sf)), 3)
    Q["quality_diff"] = lambda s, sf: _quality_pair(s, sf, P.quality_diff)
    Q["quality_score"] = lambda s, sf: _quality_pair(s, sf, "score")
    # cleaning
    Q["missing_policy"] = lambda s, sf: C.missing_policy(_dirty(s, sf))
    Q["drop_incomplete"] = lambda s, sf: C.drop_incomplete(_dirty(s, sf))
    Q["retention"] = lambda s, sf: C.retention(_dirty(s, sf), C.drop_incomplete(_dirty(s, sf)))
    Q["drop_duplicates"] = lambda s, sf: C.drop_duplicates(_dirty(s, sf))
    Q["recode_codes"] = lambda s, sf: C.recode(C.recode(_acc(s, sf), "EDUCATION", C.EDUCATION_RECODE),
                                               "MARRIAGE", C.MARRIAGE_RECODE)
    Q["validate_status_codes"] = lambda s, sf: C.validate_codes(_acc(s, sf), "PAY_0", STATUS_CODES)
    Q["clamp_status_codes"] = lambda s, sf: C.clamp_codes(_acc(s, sf), STATUS)
    Q["negative_report"] = lambda s, sf: C.negative_report(_dirty(s, sf))
    Q["treat_negatives"] = lambda s, sf: C.treat_negatives(_dirty(s, sf))
    Q["outlier_report"] = lambda s, sf: C.outlier_report(_dirty_table(s, sf), accuracy=EXACT)
    Q["cap_outliers"] = lambda s, sf: (lambda t: C.cap_outliers(t, C.outlier_report(t, accuracy=EXACT)))(_dirty_table(s, sf))
    Q["winsorize"] = lambda s, sf: C.winsorize(_acc_table(s, sf), accuracy=EXACT)
    Q["clean_accounts"] = lambda s, sf: C.clean_accounts(_acc_table(s, sf), accuracy=EXACT)
    Q["consistency_report"] = lambda s, sf: C.consistency_report(_dirty(s, sf))
    Q["unrealistic_ages"] = lambda s, sf: C.rule_values(_dirty(s, sf), (F.col("AGE") < 18) | (F.col("AGE") > 100), "AGE")
    Q["treat_missing"] = lambda s, sf: C.treat_missing(_dirty_table(s, sf), accuracy=EXACT)
    Q["cleanse"] = lambda s, sf: cleanse(_dirty(s, sf), accuracy=EXACT)
    # distributions / statistics
    Q["education_distribution"] = lambda s, sf: S.distribution(_acc(s, sf), "EDUCATION", EDUCATION_LABELS)
    Q["class_balance"] = lambda s, sf: S.class_balance(_acc(s, sf))
    Q["numeric_stats"] = lambda s, sf: _round(S.numeric_stats(_acc_table(s, sf), ["LIMIT_BAL", "AGE"], accuracy=EXACT),
                                              ["mean", "stddev"])
    Q["limit_bands"] = lambda s, sf: S.band_report(_acc(s, sf), "LIMIT_BAL", S.LIMIT_BANDS, S.LIMIT_BANDS_ELSE)
    Q["age_bands"] = lambda s, sf: S.band_report(_acc(s, sf), "AGE", S.AGE_BANDS, S.AGE_BANDS_ELSE)
    Q["status_distribution"] = lambda s, sf: S.period_distribution(_acc(s, sf))
    Q["status_stats"] = lambda s, sf: _round(S.period_stats(_acc_table(s, sf), STATUS, accuracy=EXACT), ["mean", "std"])
    Q["bill_payment_stats"] = lambda s, sf: _round(S.period_stats(_acc_table(s, sf), BILLS + PAYS, accuracy=EXACT,
                                                                  scale=1e3), ["mean", "std"])
    Q["panel_patterns"] = lambda s, sf: S.panel_pattern_counts(_acc(s, sf), STATUS)
    Q["period_efficiency"] = lambda s, sf: _round(S.period_efficiency(_acc_table(s, sf), accuracy=EXACT),
                                                  ["mean_efficiency", "median_efficiency"])
    Q["utilisation"] = lambda s, sf: _round(S.utilisation(_acc(s, sf)), ["mean_utilisation"])
    Q["zero_payments"] = lambda s, sf: S.zero_payments(_acc(s, sf), PAYS)
    Q["rate_by_education"] = lambda s, sf: _round(S.rate_by(_acc(s, sf), "EDUCATION"), ["rate"])
    Q["utilisation_by_label"] = lambda s, sf: _round(S.mean_by_label(_feat(s, sf), "CREDIT_UTILIZATION_RATIO"), ["mean"])
    Q["utilisation_percentiles"] = lambda s, sf: S.percentiles(_feat_table(s, sf), "CREDIT_UTILIZATION_RATIO", accuracy=EXACT)
    Q["above_own_percentile"] = lambda s, sf: S.above_own_percentile(_feat_table(s, sf), "CREDIT_UTILIZATION_RATIO", 0.9,
                                                                      accuracy=EXACT)
    Q["high_utilisation_count"] = lambda s, sf: S.threshold_count(_feat(s, sf), F.col("CREDIT_UTILIZATION_RATIO") > 0.8)
    # correlation
    Q["label_correlations"] = lambda s, sf: _round(S.label_correlations(_acc(s, sf)), ["r", "abs_r"])
    Q["correlation_strength"] = lambda s, sf: S.correlation_strength(S.label_correlations(_acc(s, sf), top=None))
    Q["correlation_extremes"] = lambda s, sf: _round(S.correlation_extremes(S.label_correlations(_acc(s, sf), top=None)),
                                                     ["positive_r", "negative_r"])
    Q["status_correlation_matrix"] = lambda s, sf: _round(S.correlation_matrix(_acc(s, sf), STATUS), ["r"])
    Q["high_correlation_pairs"] = lambda s, sf: _round(S.high_correlation_pairs(
        S.correlation_matrix(_feat_table(s, sf), NUMERIC_FEATURES + [LABEL])), ["r"])
    # feature band reports
    for key, feat in [("band_payment_trend", "PAYMENT_TREND_SLOPE"), ("band_improvement", "PAYMENT_IMPROVEMENT_SCORE"),
                      ("band_recovery", "RECOVERY_INSTANCES"), ("band_bill_trend", "BILL_TREND_SLOPE"),
                      ("band_efficiency", "AVG_PAYMENT_EFFICIENCY"), ("band_efficiency_trend", "PAYMENT_EFFICIENCY_TREND"),
                      ("band_utilisation", "CREDIT_UTILIZATION_RATIO"),
                      ("band_utilisation_trend", "CREDIT_UTILIZATION_TREND")]:
        Q[key] = (lambda f: lambda s, sf: B.feature_band_report(_feat(s, sf), f))(feat)
    Q["behaviour_distribution"] = lambda s, sf: B.class_report(_feat(s, sf), "PAYMENT_BEHAVIOR_TYPE")
    Q["risk_category_distribution"] = lambda s, sf: B.class_report(_feat(s, sf), "RISK_SCORE_CATEGORY")
    Q["debt_report"] = lambda s, sf: B.debt_report(_feat(s, sf))
    Q["basic_utilisation_report"] = lambda s, sf: _round(B.basic_utilisation_report(_feat_table(s, sf), accuracy=EXACT),
                                                         ["avg_util"])
    Q["buffer_report"] = lambda s, sf: _round(B.buffer_report(_feat_table(s, sf), accuracy=EXACT), ["avg_buffer"])
    # evaluation of the score-as-model
    Q["confusion_report"] = lambda s, sf: E.confusion_report(_pred(s, sf))
    Q["classification_metrics"] = lambda s, sf: _round(E.classification_metrics(E.score_as_model(_feat_table(s, sf))),
                                                       ["accuracy", "weighted_precision", "weighted_recall", "f1", "auc"], 9)
    Q["model_grade"] = lambda s, sf: _round(E.grade_models(E.classification_metrics(
        E.score_as_model(_feat_table(s, sf))).select(
        F.lit("TEMPORAL_RISK_SCORE").alias("model"), "auc")), ["auc"], 9)
    Q["confidence_report"] = lambda s, sf: _round(E.confidence_report(_pred(s, sf)), ["mean_confidence"])
    Q["risk_performance"] = lambda s, sf: _round(E.group_performance(_pred(s, sf), "RISK_SCORE_CATEGORY"),
                                                 ["actual_default_rate", "predicted_default_rate"])
    Q["segment_performance"] = lambda s, sf: _round(E.segment_performance(_pred(s, sf)),
                                                    ["actual_default_rate", "predicted_default_rate"])
    Q["risk_distribution"] = lambda s, sf: E.risk_distribution(_pred(s, sf))
    Q["intervention_value"] = lambda s, sf: E.intervention_value(_pred(s, sf))
    Q["intervention_value_by_segment"] = lambda s, sf: E.intervention_value(_pred(s, sf), by="CUSTOMER_SEGMENT")
    Q["split_report"] = lambda s, sf: _round(M.split_report(_acc(s, sf)), ["default_rate"])
    # chart data
    Q["age_histogram"] = lambda s, sf: S.histogram(_acc(s, sf), "AGE", 25)
    Q["utilisation_histogram_by_label"] = lambda s, sf: S.histogram(_feat(s, sf), "CREDIT_UTILIZATION_RATIO", 30, by=LABEL)
    Q["utilisation_scatter_sample"] = lambda s, sf: S.scatter_sample(
        _feat(s, sf), ["CREDIT_UTILIZATION_RATIO", "LIMIT_BAL", LABEL], 500)
    Q["limit_histogram"] = lambda s, sf: S.histogram(_acc(s, sf), "LIMIT_BAL", 30, scale=1e3)
    Q["improvement_histogram"] = lambda s, sf: S.histogram(_feat(s, sf), "PAYMENT_IMPROVEMENT_SCORE", 40)
    Q["score_histogram_by_label"] = lambda s, sf: S.histogram(_feat(s, sf), "TEMPORAL_RISK_SCORE", 30, by=LABEL)
    Q["efficiency_histogram_by_label"] = lambda s, sf: S.histogram(_feat(s, sf), "AVG_PAYMENT_EFFICIENCY", 30, by=LABEL)
    Q["sex_distribution"] = lambda s, sf: S.distribution(_acc(s, sf), "SEX", SEX_LABELS)
    Q["marriage_distribution"] = lambda s, sf: S.distribution(_acc(s, sf), "MARRIAGE", MARRIAGE_LABELS)
    for key, grp in [("rate_by_segment", "CUSTOMER_SEGMENT"), ("rate_by_behaviour", "PAYMENT_BEHAVIOR_TYPE"),
                     ("rate_by_sex", "SEX"), ("rate_by_latest_status", "PAY_0")]:
        Q[key] = (lambda g: lambda s, sf: _round(S.rate_by(_feat(s, sf), g), ["rate"]))(grp)
    # model training (rows-only checks)
    Q["model_evaluation"] = _model_evaluation
    Q["feature_importance"] = lambda s, sf: _importance(s, sf)
    Q["importance_by_category"] = lambda s, sf: _importance(s, sf, by_category=True)
    Q["importance_comparison"] = _importance_comparison
    Q["model_checks"] = _model_checks
    Q["cross_validated_model"] = _cross_validated
    Q["skipped_rows"] = _skipped_rows
    Q["cv_folds"] = _cv_folds
    Q["grid_candidates"] = _grid_candidates
    Q["model_selection"] = _model_selection
    Q["importance_labels"] = _importance_labels
    Q["importance_comparison_checks"] = _importance_comparison_checks
    # panels with gaps, categories by name, variable ids
    Q["features_dirty"] = lambda s, sf: all_features(_dirty(s, sf))
    Q["features_reduced"] = lambda s, sf: all_features(_dirty(s, sf).drop(*GONE))
    Q["features_few_months"] = lambda s, sf: all_features(_dirty(s, sf).drop(*FEW))
    Q["profile_by_name"] = lambda s, sf: P.profile_by_name(all_features(_dirty(s, sf)), FEATURE_NAME_RULES, FEATURE_NAMES, exact_distinct=True)
    Q["profile_by_model_rules"] = lambda s, sf: P.profile_by_name(
        all_features(_dirty(s, sf)), MODEL_NAME_RULES, [*VARIABLE_IDS, *FEATURE_NAMES], exact_distinct=True)
    Q["correlation_variables"] = lambda s, sf: _round(with_variables(S.label_correlations(_acc(s, sf), top=None)), ["r", "abs_r"])
    # sources and sinks
    Q["parquet_accounts"] = _parquet_accounts
    Q["csv_accounts"] = lambda s, sf: _csv_parts(s, sf)[0]
    Q["csv_lines"] = _csv_lines
    Q["run_metrics"] = _run_metrics
    Q["saved_model"] = _saved_model
    for status in STATUS[1:]:
        Q[f"validate_codes_{status.lower()}"] = (lambda c: lambda s, sf: C.validate_codes(_acc(s, sf), c, STATUS_CODES))(status)
    for code, valid in (("SEX", (1, 2)), ("EDUCATION", (1, 2, 3, 4)), ("MARRIAGE", (1, 2, 3))):
        Q[f"validate_codes_{code.lower()}"] = (lambda c, v: lambda s, sf: C.validate_codes(_acc(s, sf), c, v))(code, valid)
    if LLM is not None:
        Q |= LLM.queries()
    return Q


def oracle_sql() -> dict[str, str]:
    from oracle.queries import SQL
    return dict(SQL) | (LLM.oracle_sql() if LLM is not None else {})
