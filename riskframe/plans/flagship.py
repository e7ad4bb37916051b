"""The minimum end-to-end slice: accounts -> features -> default rate per risk
category ("what share of customers defaults in each risk category?")."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.functions.panel import LABEL
from riskframe.operators.features import all_features
from riskframe.operators.stats import pivot_rate
from riskframe.sources.fixtures import accounts


def risk_category_default_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_rate(all_features(accounts(spark, sf_dir)), "RISK_SCORE_CATEGORY", LABEL)
