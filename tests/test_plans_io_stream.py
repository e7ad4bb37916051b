"""Compositions, persistence sinks and the streaming path."""

import os
import tempfile

from pyspark.sql import functions as F

from riskframe.operators import evaluation as E
from riskframe.operators import ml as M
from riskframe.operators.features import all_features
from riskframe.plans.insights import business_insights
from riskframe.sources.fixtures import accounts
from riskframe.sources.io import save_models, write_run_metrics

SF = "/root/testdata/sf0.001"


def test_business_insights_bundle(spark):
    pred = E.score_as_model(all_features(accounts(spark, SF)))
    out = business_insights(pred)
    assert {"confusion", "metrics", "value", "risk_distribution", "risk_performance", "segments"} <= set(out)
    c = out["confusion"].first()
    assert c["tp"] + c["fp"] + c["tn"] + c["fn"] == pred.count()
    assert 0.0 <= out["metrics"].first()["auc"] <= 1.0


def test_cv_tuning_save_and_run_table(spark):
    feat = all_features(accounts(spark, SF))
    tr, _, te = M.split_data(feat, key="ID")
    num, cat = M.prepare_features(feat, method="core")
    prep, names = M.fit_preprocessing(tr, num, cat)
    lr = M.model_zoo()["Logistic Regression"].setMaxIter(10)
    from pyspark.ml.tuning import ParamGridBuilder
    grid = {"Logistic Regression": ParamGridBuilder().addGrid(lr.regParam, [0.01, 1.0]).build()}
    ms = M.train_models(prep.transform(tr), {"Logistic Regression": lr}, tune=True, folds=2, grids=grid)
    assert "Logistic Regression" in ms.models and not ms.failures
    d = tempfile.mkdtemp(prefix="rf-models-")
    paths = save_models(ms.models, d)
    assert os.path.isdir(paths["Logistic Regression"]) and paths["Logistic Regression"].endswith("logistic_regression")
    metrics = M.evaluate_models(ms, prep.transform(te))
    write_run_metrics(metrics, f"{d}/runs", "r1")
    write_run_metrics(metrics, f"{d}/runs", "r2")
    assert spark.read.parquet(f"{d}/runs").select("run_id").distinct().count() == 2


def test_failed_model_is_reported(spark):
    feat = all_features(accounts(spark, SF))
    num, cat = M.prepare_features(feat, method="core")
    prep, names = M.fit_preprocessing(feat, num, cat)
    bad = M.model_zoo(n_features=len(names) + 7)["Neural Network"].setMaxIter(2)  # wrong input layer size
    ms = M.train_models(prep.transform(feat), {"Neural Network": bad})
    ev = M.evaluate_models(ms, prep.transform(feat)).first()
    assert ev["error"] is not None and ev["auc"] is None


def test_score_stream_matches_batch(spark):
    from riskframe.streaming import score_stream
    d = tempfile.mkdtemp(prefix="rf-stream-")
    acc = accounts(spark, SF)
    acc.write.mode("overwrite").parquet(f"{d}/in")
    stream = spark.readStream.schema(acc.schema).parquet(f"{d}/in")
    q = (score_stream(stream).select("ID", "TEMPORAL_RISK_SCORE").writeStream.format("memory")
         .queryName("rf_scores").outputMode("append").option("checkpointLocation", f"{d}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.table("rf_scores")
    batch = all_features(spark.read.parquet(f"{d}/in")).select("ID", "TEMPORAL_RISK_SCORE")
    assert got.count() == batch.count() and got.exceptAll(batch).count() == 0
