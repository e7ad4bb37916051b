"""Phase-level workflows run end to end on sf0.001."""

from riskframe.operators.features import all_features
from riskframe.plans.exploration import explore
from riskframe.plans.feature_reports import feature_reports
from riskframe.plans.training import train_and_evaluate
from riskframe.sources.fixtures import accounts
from riskframe.operators import ml as M

SF = "/root/testdata/sf0.001"


def test_explore_and_feature_reports(spark):
    acc = accounts(spark, SF)
    ex = explore(acc)
    assert ex["shape"].first()["n_rows"] == 150
    assert {"status_distribution", "limit_bands", "age_bands", "correlations"} <= set(ex)
    for name, df in ex.items():
        df.collect()
    fr = feature_reports(all_features(acc))
    assert "bands_payment_trend_slope" in fr and "risk_category_rate" in fr
    for name, df in fr.items():
        df.collect()


def test_train_and_evaluate(spark):
    feat = all_features(accounts(spark, SF))
    zoo = M.model_zoo()
    zoo = {"Logistic Regression": zoo["Logistic Regression"].setMaxIter(20),
           "Random Forest": zoo["Random Forest"].setNumTrees(10)}
    out = train_and_evaluate(feat, models=zoo, method="core")
    assert out["metrics"].count() == 2
    assert out["best_model"] in zoo
    assert out["insights"]["confusion"].first()["tp"] >= 0
    out["importance_by_category"].collect()
    out["confidence"].collect()
