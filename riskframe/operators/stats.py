"""Group distributions, descriptive statistics, correlation and chart data
(D1-D18, R1-R5, V1-V6).

Totals for percentages enter as a scalar subquery (one cheap count job), never
as an unpartitioned window: a window over a grouped result is one task and the
group count is not bounded for an arbitrary column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import ladder, qcol
from riskframe.functions.panel import DEFAULT_PANEL, LABEL, STATUS_MEANINGS, PeriodPanel
from riskframe.operators._agg import long_form, numeric_columns, pct
from riskframe.operators.selection import percentile_columns, percentile_values


def _with_share(grouped: DataFrame, count_col: str = "count") -> DataFrame:
    """% of all rows from the grouped result itself: the total is a scalar
    subquery over the same grouped plan, so AQE reuses its shuffle stage and
    the source is read once."""
    total = grouped.agg(F.sum(count_col)).scalar()
    return grouped.withColumn("pct", pct(F.col(count_col), total))


# ------------------------------------------------------------------ distributions
def distribution(df: DataFrame, col, labels: dict | None = None, fallback_prefix: str = "Code ",
                 name: str = "value") -> DataFrame:
    """Count and % of all rows per value, optional code label."""
    c = qcol(col) if isinstance(col, str) else col
    out = _with_share(df.groupBy(c.alias(name)).count())
    if labels:
        from riskframe.functions.columns import codes_lookup
        out = out.withColumn("label", codes_lookup(F.col(name), labels, fallback_prefix))
    return out


def band_report(df: DataFrame, col, steps, otherwise, name: str = "band") -> DataFrame:
    """D5/D6/F*: band a column with a ladder, then count and % per band."""
    return distribution(df, ladder(col, steps, otherwise), name=name)


# ---- fixed values: band ladders of the source study ----
LIMIT_BANDS = [("<", 50000, "< 50K"), ("<", 100000, "50K-100K"), ("<", 200000, "100K-200K"),
               ("<", 500000, "200K-500K")]
LIMIT_BANDS_ELSE = ">= 500K"
AGE_BANDS = [("<", 30, "< 30"), ("<", 40, "30-39"), ("<", 50, "40-49"), ("<", 60, "50-59")]
AGE_BANDS_ELSE = ">= 60"
# ---- end of fixed values ----


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """D3: rows, defaults, default rate %, ratio 0:1, and a note
    (<10% imbalanced, >40% high, else reasonable); ``balanced_30_70`` is the model
    phase's own rule (30-70 % is balanced)."""
    y = qcol(label)
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("n_default"),
                 F.count_if(y == 0).alias("n_no_default"))
    rate = pct(F.col("n_default"), F.col("n"))
    return agg.select("n", "n_default", "n_no_default", rate.alias("default_rate"),
                      F.try_divide(F.col("n_no_default"), F.col("n_default")).alias("ratio"),
                      F.when(rate < 10, "Highly imbalanced").when(rate > 40, "High default rate")
                      .otherwise("Reasonably balanced").alias("note"),
                      rate.between(30, 70).alias("balanced_30_70"))


def numeric_stats(df: DataFrame, cols, accuracy: int | None = 10000) -> DataFrame:
    """Min, max, mean, median (of a sketch, exact for ``accuracy=None``), sample stddev,
    one pass beside the exact selection."""
    median = percentile_columns(df, {c: (qcol(c), [0.5]) for c in cols}, accuracy)
    return long_form(df, {c: {"min": F.min(qcol(c)).cast("double"), "max": F.max(qcol(c)).cast("double"),
                              "mean": F.avg(qcol(c)), "median": median[c][0].cast("double"),
                              "stddev": F.stddev_samp(qcol(c))} for c in cols})


def _unpivot(df: DataFrame, cols_by_period: dict, value: str = "value") -> DataFrame:
    """Wide panel -> long (period, value); a narrow generator, no shuffle."""
    return df.select(F.inline(F.array(*[F.struct(F.lit(p).alias("period"), qcol(c).alias(value))
                                        for p, c in cols_by_period.items()])))


def period_distribution(df: DataFrame, panel: PeriodPanel = DEFAULT_PANEL) -> DataFrame:
    """Status code distribution per month with its meaning -- one shuffle for
    all months (the study: one grouped job per month)."""
    by_m = panel.by_month(df.columns, "status")
    long = _unpivot(df, {m: by_m[m] for m in sorted(by_m)}, "code")
    from riskframe.functions.columns import codes_lookup
    # every period has one row per account: total rows = sum of counts / periods
    counts = long.groupBy("period", "code").count()
    total = counts.agg(F.sum("count") / len(by_m)).scalar()
    return (counts.withColumn("pct", pct(F.col("count"), total))
            .withColumn("meaning", codes_lookup(F.col("code"), STATUS_MEANINGS, "Unknown ")))


def period_stats(df: DataFrame, cols, accuracy: int | None = 10000, scale: float = 1.0) -> DataFrame:
    """Mean, median, sample std, min, max per column, one wide
    aggregate (map-side partial aggregation; no row duplication); the medians are
    selected beforehand for ``accuracy=None``."""
    def v(c):
        return qcol(c) / scale if scale != 1.0 else qcol(c)
    median = percentile_columns(df, {c: (v(c), [0.5]) for c in cols}, accuracy)
    return long_form(df, {c: {"mean": F.avg(v(c)), "median": median[c][0].cast("double"),
                              "std": F.stddev_samp(v(c)), "min": F.min(v(c)).cast("double"),
                              "max": F.max(v(c)).cast("double")} for c in cols})


def panel_pattern_counts(df: DataFrame, cols) -> DataFrame:
    """Customers with every month <= 0, any month > 0, any month >= 3."""
    cs = [qcol(c) for c in cols]
    all_le0 = F.lit(True)
    any_gt0 = F.lit(False)
    any_ge3 = F.lit(False)
    for c in cs:
        all_le0, any_gt0, any_ge3 = all_le0 & (c <= 0), any_gt0 | (c > 0), any_ge3 | (c >= 3)
    n = F.count(F.lit(1))
    return df.agg(n.alias("n"), F.count_if(all_le0).alias("always_on_time"),
                  F.count_if(any_gt0).alias("ever_late"), F.count_if(any_ge3).alias("ever_3plus_late")) \
        .select("*", pct(F.col("always_on_time"), F.col("n")).alias("always_on_time_pct"),
                pct(F.col("ever_late"), F.col("n")).alias("ever_late_pct"),
                pct(F.col("ever_3plus_late"), F.col("n")).alias("ever_3plus_late_pct"))


def period_efficiency(df: DataFrame, panel: PeriodPanel = DEFAULT_PANEL, accuracy: int | None = 10000) -> DataFrame:
    """pay/bill efficiency per month (0 when bill <= 0): mean and median."""
    bills, paid = panel.by_month(df.columns, "bill"), panel.by_month(df.columns, "paid")
    e = {f"month_{m}": F.when(qcol(bills[m]) > 0, qcol(paid[m]) / qcol(bills[m])).otherwise(0.0) for m in sorted(set(bills) & set(paid))}
    median = percentile_columns(df, {m: (x, [0.5]) for m, x in e.items()}, accuracy)
    return long_form(df, {m: {"mean_efficiency": F.avg(x), "median_efficiency": median[m][0]} for m, x in e.items()}, key="month")


def utilisation(df: DataFrame, bill: str = "BILL_AMT1", limit: str = "LIMIT_BAL") -> DataFrame:
    """Mean utilisation of the latest bill (0 when limit <= 0)."""
    u = F.when(qcol(limit) > 0, qcol(bill) / qcol(limit)).otherwise(0.0)
    return df.agg(F.avg(u).alias("mean_utilisation"))


def zero_payments(df: DataFrame, cols) -> DataFrame:
    """Zero-payment count and % per month."""
    total = F.count(F.lit(1))
    return long_form(df, {c: {"zero_count": F.count_if(qcol(c) == 0),
                              "zero_pct": pct(F.count_if(qcol(c) == 0), total)} for c in cols})


def rate_by(df: DataFrame, group, label: str = LABEL) -> DataFrame:
    """Label rate (mean x 100) and size per group."""
    g = qcol(group) if isinstance(group, str) else group
    return df.groupBy(g).agg(F.count(F.lit(1)).alias("n"), (F.avg(qcol(label)) * 100).alias("rate"))


def mean_by_label(df: DataFrame, feature: str, label: str = LABEL) -> DataFrame:
    """Mean of a feature per label value."""
    return df.groupBy(qcol(label).alias("label")).agg(F.avg(qcol(feature)).alias("mean"))


def pivot_rate(df: DataFrame, group: str, label: str = LABEL, values=(0, 1)) -> DataFrame:
    """Group x label counts, total and default rate %.

    Label values are passed explicitly (Q13): a missing label still gets its
    column (0), and ``pivot`` needs no extra distinct-values scan."""
    vals = list(values)
    p = df.groupBy(qcol(group)).pivot(label, vals).count().fillna(0, subset=[str(v) for v in vals])
    total = None
    for v in vals:
        total = F.col(f"`{v}`") if total is None else total + F.col(f"`{v}`")
    pos = F.col(f"`{vals[-1]}`")
    return p.withColumn("total", total).withColumn(
        "default_rate", F.when(F.col("total") > 0, pos / F.col("total") * 100).otherwise(0.0))


def percentiles(df: DataFrame, col: str, probs=(0.1, 0.25, 0.5, 0.75, 0.9), accuracy: int | None = 10000) -> DataFrame:
    """Percentile vector of a column, long form (prob, value)."""
    values = percentile_columns(df, {"v": (qcol(col), list(probs))}, accuracy)["v"]
    return df.agg(F.array(*[F.struct(F.lit(float(p)).alias("prob"), v.cast("double").alias("value")) for p, v in zip(probs, values)]).alias("_rows")).select(
        F.inline("_rows"))


def threshold_count(df: DataFrame, predicate: Column, name: str = "n") -> DataFrame:
    """Rows meeting a predicate, and their %."""
    return df.agg(F.count_if(predicate).alias(name), F.count(F.lit(1)).alias("_t")) \
        .select(name, pct(F.col(name), F.col("_t")).alias("pct"))


def above_own_percentile(df: DataFrame, col: str, q: float = 0.9, accuracy: int | None = 10000) -> DataFrame:
    """D18 (percentile case): rows at or above the column's own q-percentile."""
    p = percentile_values(df, {"v": (qcol(col), [q])}, accuracy)["v"][0]
    return threshold_count(df, qcol(col) >= F.lit(p))


# ------------------------------------------------------------------ correlation
def _safe_r(a: Column, b: Column) -> Column:
    """Pearson r as covar_pop / (std_pop * std_pop) over rows where both are
    present; NULL (not a DIVIDE_BY_ZERO error) for a constant column (Q3)."""
    both = a.isNotNull() & b.isNotNull()
    aa, bb = F.when(both, a).cast("double"), F.when(both, b).cast("double")
    return F.try_divide(F.covar_pop(aa, bb), F.stddev_pop(aa) * F.stddev_pop(bb))


def strength(abs_r: Column) -> Column:
    return (F.when(abs_r >= 0.3, "Strong").when(abs_r >= 0.1, "Moderate").when(abs_r >= 0.05, "Weak")
            .otherwise("Very Weak"))


def label_correlations(df: DataFrame, cols=None, label: str = LABEL, top: int | None = 15,
                       exclude=("ID",)) -> DataFrame:
    """R of each numeric column with the label, ordered by |r|, top-k.

    One pass for all columns (the study: one job per column): each row is
    unpivoted into (column, x, y) by a narrow generator, then ``groupBy(column)``
    with three moment aggregates.  Map-side partial aggregation leaves k rows
    per task, so the shuffle is tiny, and the small per-row aggregate loop is
    ~3x faster than one wide aggregate of 3k moment functions.  Pairwise-
    complete rows; a constant column gives NULL, not an error (Q3)."""
    cols = cols or [c for c in numeric_columns(df, exclude=exclude) if c != label]
    y = qcol(label).cast("double")
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), qcol(c).cast("double").alias("x"),
                                                  y.alias("y")) for c in cols])))
    x, yy = F.col("x"), F.col("y")
    xm, ym = F.when(yy.isNotNull(), x), F.when(x.isNotNull(), yy)
    out = long.groupBy("column_name").agg(
        F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym)).alias("r"))
    out = out.withColumn("abs_r", F.abs("r")).withColumn("strength", strength(F.col("abs_r")))
    if top is not None:
        out = out.orderBy(F.desc_nulls_last("abs_r"), "column_name").limit(top)
    return out


def correlation_strength(corrs: DataFrame) -> DataFrame:
    """R2: number of columns per strength class."""
    return corrs.groupBy("strength").count()


def correlation_extremes(corrs: DataFrame) -> DataFrame:
    """Strongest positive and strongest negative correlation."""
    return corrs.agg(F.max_by(F.when(F.col("r") > 0, F.col("column_name")), F.when(F.col("r") > 0, F.col("r")))
                     .alias("strongest_positive"), F.max(F.when(F.col("r") > 0, F.col("r"))).alias("positive_r"),
                     F.min_by(F.when(F.col("r") < 0, F.col("column_name")), F.when(F.col("r") < 0, F.col("r")))
                     .alias("strongest_negative"), F.min(F.when(F.col("r") < 0, F.col("r"))).alias("negative_r"))


def correlation_matrix(df: DataFrame, cols, diagonal: bool = False) -> DataFrame:
    """Long-form Pearson matrix (a, b, r) for a before b in list order.

    MLlib ``Correlation.corr`` over an assembled vector: one distributed
    treeAggregate of the column Gramian; only the k x k matrix (schema-sized)
    reaches the driver.  Rows with a NULL in any column are skipped (the
    assembler's ``skip``); a constant column's NaN becomes NULL (R5)."""
    import math

    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    cols = list(cols)
    src = df.select(*[qcol(c).cast("double").alias(f"_c{i}") for i, c in enumerate(cols)])
    vec = VectorAssembler(inputCols=[f"_c{i}" for i in range(len(cols))], outputCol="_v",
                          handleInvalid="skip").transform(src).select("_v")
    row = Correlation.corr(vec, "_v", "pearson").first()
    mat = row[0].toArray() if row is not None else None
    rows = []
    for i, a in enumerate(cols):
        for j in range(i if diagonal else i + 1, len(cols)):
            r = None if mat is None else float(mat[i][j])
            rows.append((a, cols[j], None if r is None or math.isnan(r) else r))
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def high_correlation_pairs(matrix: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs with |r| above the threshold."""
    return matrix.where(F.abs("r") > threshold)


# ------------------------------------------------------------------ chart data
def histogram(df: DataFrame, col: str, bins: int, by: str | None = None, scale: float = 1.0) -> DataFrame:
    """V1: equi-width histogram.  One min/max pair (scalar subqueries) serves
    every group; the maximum falls in the last bin (closed on the right)."""
    v = (qcol(col) / scale if scale != 1.0 else qcol(col)).cast("double")
    mn_v, mx_v = df.agg(F.min(v), F.max(v)).first()  # one small job for every group
    mn, mx = F.lit(mn_v).cast("double"), F.lit(mx_v).cast("double")
    idx = F.least(F.coalesce(F.floor(F.try_divide((v - mn) * bins, mx - mn)), F.lit(0)) + 1, F.lit(bins))
    keys = ([qcol(by).alias("group")] if by else []) + [idx.cast("int").alias("bin")]
    out = df.where(v.isNotNull()).groupBy(*keys).count()
    width = (mx - mn) / bins
    return out.withColumn("lower", mn + (F.col("bin") - 1) * width).withColumn("upper", mn + F.col("bin") * width)


def scatter_sample(df: DataFrame, cols, n: int, key: str = "ID") -> DataFrame:
    """V6: bounded, deterministic sample of a projection for plotting."""
    from riskframe.sources.io import sample_rows
    return sample_rows(df.select(*dict.fromkeys([key, *cols])), n, key)
