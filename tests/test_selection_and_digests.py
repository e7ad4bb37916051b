"""Exact percentiles by selection, and duplicates by digest, then by bytes."""

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from riskframe.operators import cleaning as C
from riskframe.operators import profile as P
from riskframe.operators import selection as X
from riskframe.operators import stats as S

SHARES = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def by_sorting(values, share):
    kept = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
    return kept[max(math.ceil(Fraction(str(share)) * len(kept)), 1) - 1] if kept else None


def same(a, b):
    return a == b or (a is not None and b is not None and a != a and b != b)


@pytest.mark.parametrize("accuracy,listed", [(10_000, 10_000), (20, 5), (50, 1)])
def test_selection_equals_sorting(spark, accuracy, listed):
    rng = random.Random(accuracy)
    n = 700
    cols = {"even": [float(rng.randint(0, 10 ** 6)) for _ in range(n)], "tied": [rng.choice([1.0, 1.0, 1.0, 2.0, 7.5, None]) for _ in range(n)],
            "wide": [rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300) for _ in range(n)], "none": [None] * n,
            "odd": [rng.choice([math.nan, math.inf, -math.inf, 0.1 + 0.2, -0.0, 5e-324]) for _ in range(n)]}
    rows = [(*r, rng.choice([None, rng.randint(-2 ** 63, 2 ** 63 - 1)]), Decimal(rng.randint(-10 ** 20, 10 ** 20)) / 1000) for r in zip(*cols.values())]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", big long, exact decimal(30,3)").repartition(7)
    got = X.exact_percentiles(df, {c: (F.col(c), SHARES) for c in df.columns}, accuracy, listed)
    for i, c in enumerate(df.columns):
        want = [by_sorting([r[i] for r in rows], p) for p in SHARES]
        assert all(same(a, b) for a, b in zip(got[c], want)), (c, got[c], want)


def test_selection_over_many_distinct_values(spark):
    n, step = 12_000_000, 7_368_787  # i -> i * step mod n visits every number once
    df = spark.range(n).select(((F.col("id") * step) % n).alias("v"), (-(F.col("id") * step) % n / 8).alias("w"))
    got = X.exact_percentiles(df, {"v": (F.col("v"), [0.01, 0.5, 0.99]), "w": (F.col("w"), [0.25])}, accuracy=2_000, listed=1_000)
    assert got["v"] == [119_999, 5_999_999, 11_879_999]
    assert got["w"] == sorted(got["w"]) and got["w"][0] == df.where(F.col("w") <= got["w"][0]).agg(F.max("w")).first()[0]
    assert df.where(F.col("w") < got["w"][0]).count() < 3_000_000 <= df.where(F.col("w") <= got["w"][0]).count()


def test_a_bracket_that_misses_its_rank_is_widened(spark, monkeypatch):
    df = spark.createDataFrame([(float(i),) for i in range(500)], "v double")
    first = X._bracket

    def wrong(df, targets, accuracy):
        first(df, targets, accuracy)
        for t, (t.low, t.high) in zip(targets, [(400.0, 410.0), (3.0, 9.0), (250.0, 250.0)]):
            t.inside = 1

    monkeypatch.setattr(X, "_bracket", wrong)
    assert X.exact_percentiles(df, {"v": (F.col("v"), [0.1, 0.5, 0.9])}, listed=20)["v"] == [49.0, 249.0, 449.0]


def test_passes_do_not_grow_with_columns(spark, jobs):
    df = spark.createDataFrame([tuple(range(i, i + 8)) for i in range(50)], ", ".join(f"c{i} long" for i in range(8)))
    seen = []
    for k in (1, 8):
        with jobs() as n:
            X.exact_percentiles(df, {f"c{i}": (F.col(f"c{i}"), [0.5, 0.9]) for i in range(k)})
        seen.append(n())
    assert seen[0] == seen[1]


def test_exact_and_sketched_operators_agree_on_small_tables(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(i, rng.randint(0, 10 ** 6), rng.choice([None, rng.randint(0, 50)])) for i in range(900)], "ID long, LIMIT_BAL long, AGE int")
    for run in (lambda a: C.outlier_report(df, ["LIMIT_BAL", "AGE"], accuracy=a), lambda a: C.winsorize(df, ["LIMIT_BAL"], accuracy=a),
                lambda a: S.numeric_stats(df, ["LIMIT_BAL", "AGE"], a), lambda a: S.percentiles(df, "AGE", accuracy=a)):
        assert sorted(map(tuple, run(None).collect())) == sorted(map(tuple, run(1_000_000).collect()))
    assert S.percentiles(df.limit(0), "AGE", accuracy=None).where("value is not null").count() == 0


# ------------------------------------------------------------------ duplicates
DIGESTS = [P.row_digest, lambda cols: [F.lit(0)], lambda cols: [F.xxhash64(cols[0]) % 3]]


@pytest.mark.parametrize("digest", DIGESTS, ids=["digest", "all clash", "some clash"])
@pytest.mark.parametrize("limit", [500_000, 0], ids=["broadcast", "shuffle"])
def test_duplicates_are_exact_whatever_the_digest(spark, monkeypatch, digest, limit):
    monkeypatch.setattr(P, "BROADCAST_DIGESTS", limit)
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b", ""]), rng.choice([None, 0.0, -0.0, math.nan])) for _ in range(300)] + [(9, "x", 1.0)]
    df = spark.createDataFrame(rows, "c1 int, h0 string, `a b` double")
    distinct = df.distinct().count()
    assert tuple(P.duplicate_count(df, digest).first()) == (301, distinct, 301 - distinct)
    report = {r["column_name"]: r for r in P.quality_report(df, digest).collect()}
    assert {c: r["null_count"] for c, r in report.items()} == {c: sum(r[i] is None for r in rows) for i, c in enumerate(df.columns)}
    assert {(r["total_records"], r["duplicate_records"]) for r in report.values()} == {(301, 301 - distinct)}


def test_duplicates_of_empty_unique_and_wide_tables(spark):
    df = spark.createDataFrame([(i, None) for i in range(20)], "a int, b string")
    assert tuple(P.duplicate_count(df).first()) == (20, 20, 0)
    assert tuple(P.duplicate_count(df.limit(0)).first()) == (0, 0, 0)
    wide = spark.createDataFrame([tuple(None if (i + k) % 3 == 0 else i % 2 for i in range(130)) for k in (0, 1, 0)], ", ".join(f"x{i} int" for i in range(130)))
    assert tuple(P.duplicate_count(wide).first()) == (3, 2, 1)
    assert [r["null_count"] for r in P.quality_report(wide).collect()] == [r["null_count"] for r in P.null_counts(wide).collect()]


def test_rows_send_digests_not_themselves(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("long text "), 50).alias("t"), F.col("id").cast("string").alias("u"))
    plan = P.digest_counts(df)._jdf.queryExecution().executedPlan().toString()
    exchange = next(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "h0" in exchange and "h1" in exchange and "c1" not in exchange
    assert P.digest_counts(df).columns == ["h0", "h1", "m0", "n"]
