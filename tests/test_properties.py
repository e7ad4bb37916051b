"""SURVEY 5.4 properties on the driver's sf0.001 data."""

import math

from pyspark.sql import functions as F

from riskframe.operators import cleaning as C
from riskframe.operators import stats as S
from riskframe.sources.fixtures import accounts, accounts_dirty

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_cleaning_steps_idempotent(spark):
    d = accounts_dirty(spark, SF)
    once = C.drop_duplicates(d)
    assert _rows(C.drop_duplicates(once)) == _rows(once)
    neg = C.treat_negatives(d)
    assert _rows(C.treat_negatives(neg)) == _rows(neg)
    clamp = C.clamp_codes(d, ["PAY_0", "PAY_2"])
    assert _rows(C.clamp_codes(clamp, ["PAY_0", "PAY_2"])) == _rows(clamp)


def test_distribution_percentages_sum_to_100(spark):
    acc = accounts(spark, SF)
    for col in ("EDUCATION", "MARRIAGE", "SEX"):
        total = S.distribution(acc, col).agg(F.sum("pct")).first()[0]
        assert math.isclose(total, 100.0, abs_tol=1e-9)
    per = S.period_distribution(acc).groupBy("period").agg(F.sum("pct").alias("p")).collect()
    assert all(math.isclose(r["p"], 100.0, abs_tol=1e-9) for r in per)


def test_correlation_matrix_diagonal_and_range(spark):
    acc = accounts(spark, SF)
    m = S.correlation_matrix(acc, ["PAY_0", "PAY_2", "BILL_AMT1", "LIMIT_BAL"], diagonal=True).collect()
    for r in m:
        if r["a"] == r["b"]:
            assert math.isclose(r["r"], 1.0, abs_tol=1e-9)
        assert r["r"] is None or -1.0 - 1e-9 <= r["r"] <= 1.0 + 1e-9
    assert len(m) == 4 + 6


def test_histogram_counts_every_row(spark):
    acc = accounts(spark, SF)
    h = S.histogram(acc, "AGE", 25)
    assert h.agg(F.sum("count")).first()[0] == acc.count()
    assert h.agg(F.max("bin")).first()[0] <= 25
