"""Evaluation operators against MLlib's evaluators; split and training smoke."""

import math

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskframe.operators import evaluation as E
from riskframe.functions.panel import LABEL
from riskframe.operators import ml as M


def _pred(spark):
    rows = [(i, (i * 7919) % 3 == 0 and 1 or 0, ((i * 37) % 101) / 100.0) for i in range(400)]
    df = spark.createDataFrame(rows, "ID int, default_next_month int, score double")
    return df.withColumn("prediction", F.when(F.col("score") >= 0.5, 1.0).otherwise(0.0)) \
        .withColumn("default_next_month", F.col("default_next_month").cast("double"))


def test_auc_matches_mllib(spark):
    p = _pred(spark)
    ours = E.auc(p, score="score").first()["auc"]
    raw = p.withColumn("rawPrediction", F.udf(lambda s: Vectors.dense([1 - s, s]), "vector")("score")) \
        if False else p.withColumn("rawPrediction", F.col("score"))
    ml = BinaryClassificationEvaluator(labelCol="default_next_month", rawPredictionCol="rawPrediction").evaluate(raw)
    assert math.isclose(ours, ml, abs_tol=1e-9)


def test_weighted_metrics_match_mllib(spark):
    p = _pred(spark)
    m = E.classification_metrics(p, score=None).first()
    for ours, name in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                       ("weighted_recall", "weightedRecall"), ("f1", "f1")]:
        ml = MulticlassClassificationEvaluator(labelCol="default_next_month", predictionCol="prediction",
                                               metricName=name).evaluate(p)
        assert math.isclose(m[ours], ml, abs_tol=1e-12), name


def test_auc_hot_score(spark):
    # one score value holding most rows is a single grouped row
    rows = [(i % 2, 0.5) for i in range(1000)] + [(1, 0.9), (0, 0.1)]
    df = spark.createDataFrame(rows, "default_next_month int, score double")
    assert math.isclose(E.auc(df).first()["auc"], (500 * 501 + 1 * 501) / (501 * 501) - 0.5 * 500 * 500 / (501 * 501))


def test_confusion_and_value(spark):
    p = _pred(spark).withColumn("default_next_month", F.col("default_next_month").cast("int"))
    c = E.confusion_report(p).first()
    assert c["tp"] + c["fp"] + c["tn"] + c["fn"] == 400
    v = E.intervention_value(p).first()
    assert math.isclose(v["net_savings"], c["tp"] * 0.3 * 50000 - (c["tp"] + c["fp"]) * 500)


def test_md5_split_disjoint_and_complete(spark):
    df = spark.range(3000).withColumnRenamed("id", "ID")
    tr, va, te = M.split_data(df, key="ID")
    ids = [set(r[0] for r in x.collect()) for x in (tr, va, te)]
    assert sum(map(len, ids)) == 3000 and not (ids[0] & ids[1]) and not (ids[1] & ids[2])
    assert 0.65 < len(ids[0]) / 3000 < 0.75
    # stable under repartitioning
    tr2, _, _ = M.split_data(df.repartition(7), key="ID")
    assert set(r[0] for r in tr2.collect()) == ids[0]


def test_training_smoke_and_importance(spark):
    from riskframe.operators.features import all_features
    from riskframe.sources.fixtures import accounts
    feat = all_features(accounts(spark, "/root/testdata/sf0.001"))
    tr, _, te = M.split_data(feat, key="ID")
    num, cat = M.prepare_features(feat, method="core")
    assert "ID" not in num and "default_next_month" not in num
    prep, names = M.fit_preprocessing(tr, num, cat)
    zoo = M.model_zoo(n_features=len(names))
    zoo["Random Forest"].setNumTrees(5)
    zoo["Gradient Boosting"].setMaxIter(3)
    zoo["Neural Network"].setMaxIter(5)
    ms = M.train_models(prep.transform(tr), zoo)
    assert not ms.failures, ms.failures
    ev = M.evaluate_models(ms, prep.transform(te))
    assert ev.count() == 4
    imp = M.feature_importance(ms.models["Random Forest"], names, "Random Forest", spark)
    assert abs(imp.agg(F.sum("importance")).first()[0] - 1.0) < 1e-6
    cats = {r["category"] for r in M.importance_by_category(imp).collect()}
    assert "Payment History" in cats
    probs = M.with_probabilities(ms.models["Logistic Regression"].transform(prep.transform(te)))
    assert probs.where(F.abs(F.col("prob_default") + F.col("prob_no_default") - 1) > 1e-9).count() == 0


def test_param_grids_use_instance_params(spark):
    zoo = M.model_zoo()
    grids = M.param_grids(zoo)
    lr = zoo["Logistic Regression"]
    assert len(grids["Logistic Regression"]) == 9
    assert all(lr.regParam in pm for pm in grids["Logistic Regression"])
    assert len(grids["Gradient Boosting"]) == 4


def test_auc_exact_across_bucket_offsets(spark):
    p = _pred(spark)
    full = E.auc(p, score="score").first()["auc"]
    for b in (2, 3, 17):
        assert math.isclose(E.auc(p, score="score", buckets=b).first()["auc"], full, abs_tol=1e-12)


def test_category_shares_are_per_model(spark):
    rows = [("a", "AGE", 0.6), ("a", "PAY_0", 0.4), ("b", "AGE", 0.5), ("b", "RISK", 0.5)]
    imp = spark.createDataFrame(rows, "model string, feature string, importance double")
    got = {(r["model"], r["category"]): round(r["pct"], 9) for r in M.importance_by_category(imp).collect()}
    assert got == {("a", "Demographics"): 60.0, ("a", "Payment History"): 40.0, ("b", "Demographics"): 50.0, ("b", "Risk"): 50.0}


def test_auc_buckets_are_even_with_an_outlier_score(spark):
    df = spark.range(20000).select((F.col("id") % 2).cast("int").alias(LABEL), (F.col("id") / 20000).alias("score")).unionByName(
        spark.createDataFrame([(1, 1e9)], f"{LABEL} int, score double"))
    dealt = df.repartitionByRange(8, "score").groupBy(F.spark_partition_id()).count()
    assert dealt.agg(F.max("count")).first()[0] < 2 * 20001 / 8
    exact = (sum((k + 1) // 2 for k in range(1, 20000, 2)) + 10000) / (10001 * 10000)
    assert math.isclose(E.auc(df, buckets=8).first()["auc"], exact, abs_tol=1e-12)
