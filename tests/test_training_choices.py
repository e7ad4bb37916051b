"""Rows counted on the way, folds and candidates, choices made without the test split, models read back."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from riskframe.functions.dictionary import variable_dictionary, with_importance_label, with_variables
from riskframe.functions.panel import FEATURE_NAME_RULES, LABEL, MODEL_NAME_RULES
from riskframe.operators import evaluation as E
from riskframe.operators import ml as M
from riskframe.operators import profile as P
from riskframe.operators.features import all_features
from riskframe.plans.training import train_and_evaluate
from riskframe.session import materialize
from riskframe.sources import io
from riskframe.sources.fixtures import accounts


@pytest.fixture(scope="module")
def feat(spark):
    return materialize(all_features(accounts(spark, SF_SMALL)))


def small_zoo(n, validation=None):
    zoo = M.model_zoo(LABEL, n, validation=validation)
    zoo["Random Forest"].setNumTrees(4)
    zoo["Gradient Boosting"].setMaxIter(6)
    zoo["Neural Network"].setMaxIter(8)
    return zoo


def test_skipped_rows_are_those_the_assembler_drops(spark, feat):
    holes = feat.withColumns({"AGE": F.when(F.col("ID") % 7 != 0, F.col("AGE")), "AVG_BILL_AMOUNT": F.when(F.col("ID") % 11 == 0, float("nan")).otherwise(F.col("AVG_BILL_AMOUNT")),
                              "SEX": F.when(F.col("ID") % 5 != 0, F.col("SEX"))})
    num, cat = M.prepare_features(feat, method="all")
    prep, _ = M.fit_preprocessing(feat, num, cat)
    parts = dict(zip(("train", "validation", "test"), M.split_data(holes, key="ID")))
    got = {r["split"]: (r["n_in"], r["n_skipped"]) for r in M.skipped_rows(parts, num).collect()}
    assert got == {name: (part.count(), part.count() - prep.transform(part).count()) for name, part in parts.items()}
    assert sum(gone for _, gone in got.values()) >= feat.where("ID % 7 = 0 or ID % 11 = 0").count()


def test_folds_do_not_depend_on_partitioning(spark):
    df = spark.range(4000).withColumnRenamed("id", "ID")
    of = lambda d: {r["ID"]: r["fold"] for r in M.with_folds(d, "ID", 5).collect()}
    folds = of(df)
    assert folds == of(df.repartition(13)) and set(folds.values()) == set(range(5))
    split = {r["ID"]: r["s"] for r in df.withColumn("s", M.split_label("ID")).collect()}
    share = sum(1 for i in folds if folds[i] == 0 and split[i] == "train") / sum(1 for i in folds if split[i] == "train")
    assert 0.17 < share < 0.23  # folds and split read different digits


def test_every_candidate_is_reported(spark, feat):
    num, cat = M.prepare_features(feat, method="core")
    prep, names = M.fit_preprocessing(feat, num, cat)
    train = materialize(M.with_folds(prep.transform(feat), "ID").select("scaledFeatures", LABEL, "fold"))
    zoo = {k: v for k, v in small_zoo(len(names)).items() if k in ("Logistic Regression", "Neural Network")}
    first = M.train_models(train, zoo, tune=True, fold_col="fold", parallelism=4)
    again = M.train_models(train.repartition(5), {"Logistic Regression": zoo["Logistic Regression"]}, tune=True, fold_col="fold", parallelism=2)
    rows = M.candidate_metrics(first, spark).collect()
    assert not first.failures, list(first.failures.values())[0][:6000]
    assert [r["model"] for r in rows].count("Logistic Regression") == 9 and len(rows) == 10
    for name in zoo:
        own = [r for r in rows if r["model"] == name]
        assert sum(r["chosen"] for r in own) == 1 and max(own, key=lambda r: r["auc"])["auc"] == next(r["auc"] for r in own if r["chosen"])
    best = next(r for r in rows if r["chosen"] and r["model"] == "Logistic Regression")["parameters"]
    fitted = first.models["Logistic Regression"]
    assert best == f"elasticNetParam={fitted.getElasticNetParam()}, regParam={fitted.getRegParam()}"
    pairs = zip([r["auc"] for r in rows if r["model"] == "Logistic Regression"], [c[3] for c in again.candidates])
    assert all(abs(a - b) < 1e-6 for a, b in pairs)


def test_the_test_split_has_no_say(spark, feat):
    names = len(M.prepare_features(feat, method="core")[0]) + len(M.prepare_features(feat, method="core")[1])
    in_test = M.split_label("ID") == "test"
    turned = feat.withColumn(LABEL, F.when(in_test, 1 - F.col(LABEL)).otherwise(F.col(LABEL)))
    runs = [train_and_evaluate(f, method="core", models=small_zoo(names, "_is_validation")) for f in (feat, turned)]
    val = [sorted(map(tuple, r["validation_metrics"].drop("training_time").collect())) for r in runs]
    assert val[0] == val[1] and runs[0]["best_model"] == runs[1]["best_model"]
    test = [{r["model"]: r["auc"] for r in x["metrics"].collect()} for x in runs]
    assert test[0] != test[1]
    best = max(runs[0]["validation_metrics"].collect(), key=lambda r: r["auc"])["model"]
    assert runs[0]["best_model"] == best and [r["model"] for r in runs[0]["metrics"].collect() if r["is_best"]] == [best]
    assert {r["split"] for r in runs[0]["skipped_rows"].collect()} == {"train", "validation", "test"}


def test_boosting_stops_on_the_validation_rows(spark, feat):
    num, cat = M.prepare_features(feat, method="core")
    prep, names = M.fit_preprocessing(feat, num, cat)
    marked = materialize(prep.transform(feat).withColumn("held", F.col("ID") % 4 == 0))
    zoo = {"Gradient Boosting": M.model_zoo(LABEL, validation="held")["Gradient Boosting"].setMaxIter(40)}
    early = M.train_models(marked, zoo, validation="held").models["Gradient Boosting"]
    full = M.train_models(marked.where("not held"), {"Gradient Boosting": M.model_zoo(LABEL)["Gradient Boosting"].setMaxIter(40)}).models["Gradient Boosting"]
    assert early.getNumTrees < full.getNumTrees == 40


def test_grades_by_another_frames_choice(spark):
    metrics = spark.createDataFrame([("a", 0.9), ("b", 0.6)], "model string, auc double")
    val = spark.createDataFrame([("a", 0.5), ("b", 0.7)], "model string, auc double")
    assert {r["model"]: (r["grade"], r["is_best"]) for r in E.grade_models(metrics, chosen_on=val).collect()} == {"a": ("Excellent", False), "b": ("Poor", True)}


def test_saved_model_in_another_session(spark, feat, tmp_path):
    num, cat = M.prepare_features(feat, method="core")
    prep, _ = M.fit_preprocessing(feat, num, cat)
    model = M.train_models(prep.transform(feat), {"Logistic Regression": M.model_zoo()["Logistic Regression"]}).models["Logistic Regression"]
    io.save_fitted(prep, model, str(tmp_path / "m"))
    feat.write.parquet(str(tmp_path / "rows"))
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from riskframe.session import local_session
from riskframe.sources.io import load_fitted
spark = local_session(cores=2)
rows = load_fitted({str(tmp_path / 'm')!r}).transform(spark.read.parquet({str(tmp_path / 'rows')!r})).select("ID", "prediction", "probability")
rows.write.parquet({str(tmp_path / 'there')!r})
"""
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=300, env=dict(os.environ))
    here = {r["ID"]: (r["prediction"], r["probability"]) for r in model.transform(prep.transform(feat)).collect()}
    there = {r["ID"]: (r["prediction"], r["probability"]) for r in spark.read.parquet(str(tmp_path / "there")).collect()}
    assert here == there and here


def test_a_run_written_again_replaces_itself_alone(spark, tmp_path):
    path = str(tmp_path / "runs")
    one = spark.createDataFrame([("lr", 0.7), ("rf", 0.8)], "model string, auc double")
    for run, rows in (("001", one), ("1", one), ("a/b", one.limit(1)), ("001", one.withColumn("auc", F.lit(0.5)))):
        io.write_run_metrics(rows, path, run)
    got = sorted((r["run_id"], r["model"], r["auc"]) for r in io.read_run_metrics(spark, path).collect())
    assert got == [("001", "lr", 0.5), ("001", "rf", 0.5), ("1", "lr", 0.7), ("1", "rf", 0.8), ("a/b", "lr", 0.7)] or len(got) == 5


def test_csv_lines_that_do_not_fit_are_kept(spark, tmp_path):
    path = str(tmp_path / "c.csv")
    lines = ["id,name,v", "1,a,2.5", "x,b,3.5", "2,c", "3,d,4.5,6", '4,"e, f",', "5,g,nan?", "6,,7"]
    (tmp_path / "c.csv").write_text("\n".join(lines) + "\n")
    schema = spark.createDataFrame([], "id int, name string, v double").schema
    good, bad = io.load_csv(spark, path, schema)
    assert sorted(map(tuple, good.collect())) == [(1, "a", 2.5), (4, "e, f", None), (6, None, 7.0)]
    assert sorted(r["line"] for r in bad.collect()) == ["2,c", "3,d,4.5,6", "5,g,nan?", "x,b,3.5"]
    assert good.schema == schema


def test_dictionary_and_name_rules(spark):
    assert variable_dictionary(spark).count() == 23
    rows = spark.createDataFrame([("AGE",), ("PAY_AMT3",), ("SEX_indexed",), ("CREDIT_BUFFER",)], "column_name string")
    assert {r[0]: (r[1], r[2]) for r in with_variables(rows).select("column_name", "variable", "variable_group").collect()} == {
        "AGE": ("X5", "Demographics"), "PAY_AMT3": ("X20", "Payment Amounts"), "SEX_indexed": ("X2", "Demographics"), "CREDIT_BUFFER": ("N/A", None)}
    imp = spark.createDataFrame([("m", f, 0.1) for f in ("BILL_AMT2", "PAY_AMT1", "PAY_0", "BILL_TREND_SLOPE", "CREDIT_BUFFER", "RISK_X", "ODD")], "model string, feature string, importance double")
    assert {r["feature"]: r["category"] for r in with_importance_label(imp).collect()} == {
        "BILL_AMT2": "Bills", "PAY_AMT1": "Payments", "PAY_0": "Payment History", "BILL_TREND_SLOPE": "Temporal", "CREDIT_BUFFER": "Credit", "RISK_X": "Risk", "ODD": "Other"}


def test_sketched_categories_come_close_to_exact_ones(spark, feat):
    wide = feat.withColumn("TREND_CODE", (F.col("ID") * 7919).cast("string")).withColumn("BILL_TREND_KEY", F.col("ID").cast("string"))
    for rules in (FEATURE_NAME_RULES, MODEL_NAME_RULES):
        exact = {r["category"]: r for r in P.profile_by_name(wide, rules, exact_distinct=True).collect()}
        sketched = {r["category"]: r for r in P.profile_by_name(wide, rules).collect()}
        assert exact.keys() == sketched.keys()
        for c, r in exact.items():
            assert abs(r["distinct_codes"] - sketched[c]["distinct_codes"]) <= 0.05 * r["distinct_codes"] + 1
            assert all(r[k] == sketched[c][k] for k in ("variables", "null_cells", "null_pct", "low_variance"))
    both = P.profile_by_name(wide, [("a", "contains", ("TREND",)), ("b", "contains", ("BILL",))], ["BILL_TREND_KEY"], exact_distinct=True)
    assert {r["category"]: r["distinct_codes"] for r in both.collect()} == {"a": feat.count(), "b": feat.count()}


def test_training_rows_are_dealt_evenly_over_the_cores(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(1000).select(F.when(F.col("id") > 5, F.col("id") % 3).alias("ID"), F.col("id").alias("n")).repartition(cores + 1, "ID")
    assert M.dealt(rows) is rows
    monkeypatch.setattr(M, "LEAST_ROWS", 1)
    for most, n in ((1000, cores), (1000 // cores - 1, 2 * cores)):
        monkeypatch.setattr(M, "MOST_ROWS", most)
        sizes = M.dealt(rows).rdd.glom().map(len).collect()
        assert len(sizes) == n and sum(sizes) == 1000 and max(sizes) <= 1000 // n + cores + 1
    assert sorted(map(str, M.dealt(rows).collect())) == sorted(map(str, rows.collect()))


def test_fits_read_dealt_rows(spark, monkeypatch):
    import __spark_entry__ as entry
    seen = []
    monkeypatch.setattr(M, "LEAST_ROWS", 1)
    monkeypatch.setattr(M, "train_models", lambda train, *a, **k: seen.append((train.rdd.getNumPartitions(), sorted(train.columns), train.count())) or M.ModelSet())
    entry._fitted(spark, "/root/testdata/sf0.001")
    n = M.split_data(entry._acc(spark, "/root/testdata/sf0.001"), key="ID")[0].count()
    assert seen == [(spark.sparkContext.defaultParallelism, sorted(["scaledFeatures", LABEL]), n)]


def test_models_fitted_together_are_those_fitted_one_by_one(spark, feat):
    num, cat = M.prepare_features(feat, method="core")
    prep, names = M.fit_preprocessing(feat, num, cat)
    rows = materialize(prep.transform(feat))
    zoo = small_zoo(len(names)) | {"Wrong": M.model_zoo(LABEL, len(names) + 7)["Neural Network"].setMaxIter(2)}
    apart, both = M.train_models(rows, zoo, LABEL), M.train_models(rows, zoo, LABEL, together=2)
    assert list(both.models) == list(apart.models) and list(both.times) == list(zoo) and list(both.failures) == ["Wrong"]
    for name in both.models:
        a, b = ([r["prediction"] for r in x.models[name].transform(rows).orderBy("ID").select("prediction").collect()] for x in (apart, both))
        assert a == b
