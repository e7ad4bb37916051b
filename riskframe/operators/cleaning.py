"""Cleaning, filters and rules.

Data-dependent constants (medians, percentiles, policies) are computed in ONE
aggregate for all columns; its single row (size = number of columns, never
rows) is read back and enters the row projection as literals.  So an operator
runs one statistics job instead of one per column, never joins the table to
its own statistics, and keeps the projection plan flat (nested scalar
subqueries over a long lineage blow up the optimiser).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskframe.functions.columns import qcol
from riskframe.functions.panel import DEFAULT_PANEL, LABEL, PeriodPanel
from riskframe.operators._agg import long_form, pct
from riskframe.operators.selection import percentile_values

#: Sketch entries of the percentiles; ``accuracy=None`` selects exact ones instead.
DEFAULT_ACCURACY = 10000


# ---------------------------------------------------------------- missing values
def missing_policy(df: DataFrame, cols=None) -> DataFrame:
    """Missing count / % and the action: 0 -> None needed; <1% Drop rows;
    <5% Impute; <20% Investigate; else Consider drop."""
    cols = list(cols or df.columns)
    total = F.count(F.lit(1))
    rep = long_form(df, {c: {"missing_count": F.count_if(qcol(c).isNull()),
                             "missing_pct": pct(F.count_if(qcol(c).isNull()), total)} for c in cols})
    return rep.withColumn("action", F.when(F.col("missing_count") == 0, "None needed")
                          .when(F.col("missing_pct") < 1, "Drop rows")
                          .when(F.col("missing_pct") < 5, "Impute")
                          .when(F.col("missing_pct") < 20, "Investigate")
                          .otherwise("Consider drop"))


def _not_null(cols) -> Column:
    keep = F.lit(True)
    for c in cols:
        keep = keep & qcol(c).isNotNull()
    return keep


def _mode_values(df: DataFrame, prior: dict) -> dict:
    """Most frequent non-null value per column (ties -> smallest value) among the rows
    where the column's ``prior`` columns are not null; all columns in ONE shuffle:
    unpivot to (column, value), count, pick.  Returns column -> literal."""
    if not prior:
        return {}
    cols = list(prior)
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("k"), F.when(_not_null(prior[c]), qcol(c).cast("string")).alias("v")) for c in cols
    ]))).where(F.col("v").isNotNull())
    counts = long.groupBy("k", "v").count()
    # order key: highest count, then smallest value
    best = counts.groupBy("k").agg(F.min_by("v", F.struct(-F.col("count"), F.col("v"))).alias("mode"))
    types = dict(df.dtypes)
    modes = {r["k"]: r["mode"] for r in best.collect()}  # one row per column
    return {c: F.lit(modes.get(c)).cast(types[c]) for c in cols}


def treat_missing(df: DataFrame, policy: DataFrame | None = None, accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    """Drop rows for "Drop rows" columns; impute "Impute" columns with the
    median (a sketch's, or the exact one for ``accuracy=None``) if numeric, else the mode.

    Columns are handled in table order, so a median only sees the row drops of
    *earlier* columns, as in the study: all medians are taken together over
    ``CASE WHEN <earlier drop cols not null> THEN c END``.  The frame is read by the policy,
    the medians, the modes and the result: give a table or a materialised frame."""
    rows = (policy if policy is not None else missing_policy(df)).collect()  # schema-sized
    action = {r["column_name"]: r["action"] for r in rows}
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    drops_so_far, med_exprs, mode_prior = [], {}, {}
    for c in df.columns:
        a = action.get(c)
        if a == "Drop rows":
            drops_so_far.append(c)
        elif a == "Impute":
            if c in numeric:
                med_exprs[c] = (F.when(_not_null(drops_so_far), qcol(c)), [0.5])
            else:
                mode_prior[c] = list(drops_so_far)
    fills = {}
    if med_exprs:
        medians = percentile_values(df, med_exprs, accuracy)
        types = dict(df.dtypes)
        fills.update({c: F.lit(medians[c][0]).cast(types[c]) for c in med_exprs})
    fills.update(_mode_values(df, mode_prior))
    out = df
    for d in drops_so_far:
        out = out.where(qcol(d).isNotNull())
    if fills:
        out = out.withColumns({c: F.coalesce(qcol(c), v) for c, v in fills.items()})
    return out


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with any null."""
    return df.na.drop()


def retention(before: DataFrame, after: DataFrame) -> DataFrame:
    """Records before / after / dropped and retention % (two count jobs)."""
    b = before.select(F.count(F.lit(1))).scalar()
    a = after.select(F.count(F.lit(1))).scalar()
    return before.sparkSession.range(1).select(
        b.alias("records_before"), a.alias("records_after"), (b - a).alias("records_dropped"),
        pct(a, b).alias("retention_pct"))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Remove full-row duplicates."""
    return df.dropDuplicates()


# ---------------------------------------------------------------- code lists
def recode(df: DataFrame, col: str, mapping: dict) -> DataFrame:
    """Replace codes, e.g. EDUCATION {0,5,6}->4, MARRIAGE {0}->3."""
    if col not in df.columns:
        return df
    c = qcol(col)
    expr = None
    targets = {}
    for src, dst in mapping.items():
        targets.setdefault(dst, []).append(src)
    for dst, srcs in targets.items():
        cond = c.isin(srcs)
        expr = F.when(cond, dst) if expr is None else expr.when(cond, dst)
    return df.withColumn(col, expr.otherwise(c))


EDUCATION_RECODE = {0: 4, 5: 4, 6: 4}
MARRIAGE_RECODE = {0: 3}


def validate_codes(df: DataFrame, col: str, valid) -> DataFrame:
    """Distribution of a code column with a per-code valid flag."""
    valid = list(valid)
    counts = df.groupBy(qcol(col).alias("code")).count()
    total = counts.agg(F.sum("count")).scalar()  # same shuffle stage, re-used
    return counts.select("code", "count", pct(F.col("count"), total).alias("pct"),
                         F.coalesce(F.col("code").isin(valid), F.lit(False)).alias("valid"))


def clamp_codes(df: DataFrame, cols, lo: int = -2, lo_to: int = -1, hi: int = 9, hi_to: int = 9) -> DataFrame:
    """Status codes below ``lo`` become ``lo_to`` (-1, "pay duly", not -2),
    above ``hi`` become ``hi_to``."""
    cols = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.when(qcol(c) < lo, lo_to).when(qcol(c) > hi, hi_to).otherwise(qcol(c))
                           for c in cols})


# ---------------------------------------------------------------- negatives
def negative_actions(cols) -> dict:
    """Default action per money column: bills may be credits, payments need a
    look, a negative limit is set to 0."""
    out = {}
    for c in cols:
        if c.startswith("BILL_AMT"):
            out[c] = "Keep (credit)"
        elif c.startswith("PAY_AMT"):
            out[c] = "Investigate"
        else:
            out[c] = "Set to 0"
    return out


def negative_report(df: DataFrame, rules: dict | None = None, panel: PeriodPanel = DEFAULT_PANEL) -> DataFrame:
    """C11: negative count, % and action per money column (one pass)."""
    cols = [c for c in panel.money() if c in df.columns] if rules is None else [c for c in rules if c in df.columns]
    rules = rules or negative_actions(cols)
    total = F.count(F.lit(1))
    rep = long_form(df, {c: {"negative_count": F.count_if(qcol(c) < 0),
                             "negative_pct": pct(F.count_if(qcol(c) < 0), total),
                             "rule": F.lit(rules[c])} for c in cols})
    return rep.withColumn("action", F.when(F.col("negative_count") > 0, F.col("rule")).otherwise("None needed")) \
        .drop("rule")


def treat_negatives(df: DataFrame, report: DataFrame | None = None, investigate_below_pct: float = 1.0) -> DataFrame:
    """C12: "Set to 0" always zeroes negatives; "Investigate" zeroes them only if
    they are under ``investigate_below_pct`` % of rows.  The one-pass report has
    one row per column; the projection is a single ``withColumns``."""
    rep = (report if report is not None else negative_report(df)).collect()  # schema-sized
    types = dict(df.dtypes)
    zero = [r["column_name"] for r in rep if r["column_name"] in types and (
        r["action"] == "Set to 0" or (r["action"] == "Investigate" and r["negative_pct"] < investigate_below_pct))]
    return df.withColumns({c: F.when(qcol(c) < 0, F.lit(0).cast(types[c])).otherwise(qcol(c)) for c in zero}) \
        if zero else df


# ---------------------------------------------------------------- outliers
def outlier_report(df: DataFrame, cols=None, k: float = 3.0, accuracy: int | None = DEFAULT_ACCURACY,
                   panel: PeriodPanel = DEFAULT_PANEL) -> DataFrame:
    """P1, P99, Q1, Q3, bounds Q1 - k*IQR / Q3 + k*IQR, outlier count and %.

    Two steps for all columns (the study: two jobs per column): the percentiles, by one
    sketch pass or by exact selection (``accuracy=None``), then one aggregate of
    ``count_if`` against the bounds as literals."""
    cols = [c for c in (cols or panel.money()) if c in df.columns]
    q = percentile_values(df, {c: (qcol(c), [0.01, 0.25, 0.75, 0.99]) for c in cols}, accuracy)
    total = F.count(F.lit(1))
    per = {}
    for c in cols:
        arr = q.get(c)
        p1, q1, q3, p99 = (float(v) for v in arr) if arr and arr[0] is not None else (None,) * 4
        lo = q1 - k * (q3 - q1) if q1 is not None else None
        hi = q3 + k * (q3 - q1) if q1 is not None else None
        n_out = F.count_if((qcol(c) < F.lit(lo)) | (qcol(c) > F.lit(hi)))
        dbl = lambda v: F.lit(v).cast("double")
        per[c] = {"p1": dbl(p1), "p99": dbl(p99), "q1": dbl(q1), "q3": dbl(q3),
                  "lower_bound": dbl(lo), "upper_bound": dbl(hi),
                  "outliers": n_out, "outlier_pct": pct(n_out, total)}
    return long_form(df, per)


def cap_outliers(df: DataFrame, report: DataFrame, min_pct: float = 0.1) -> DataFrame:
    """C14: cap at P99, above only, where outliers > 0 and > ``min_pct`` % of rows.
    All bounds come from the report (taken before any cap): one projection."""
    types = dict(df.dtypes)
    out = {}
    for r in report.collect():  # one row per column
        c = r["column_name"]
        if c in types and r["outliers"] and r["outliers"] > 0 and r["outlier_pct"] > min_pct:
            p99 = F.lit(r["p99"]).cast(types[c])
            out[c] = F.when(qcol(c) > p99, p99).otherwise(qcol(c))
    return df.withColumns(out) if out else df


def _p99_caps(df: DataFrame, cols, q: float, accuracy: int | None) -> dict:
    types = dict(df.dtypes)
    stats = percentile_values(df, {c: (qcol(c), [q]) for c in cols}, accuracy)
    return {c: F.lit(stats[c][0]).cast(types[c]) for c in cols if stats[c][0] is not None}


def winsorize(df: DataFrame, cols=None, q: float = 0.99, accuracy: int | None = DEFAULT_ACCURACY,
              panel: PeriodPanel = DEFAULT_PANEL) -> DataFrame:
    """Unconditional cap at the ``q`` percentile of the *input* frame.

    One sketch pass (or exact selection, ``accuracy=None``) for all columns + one
    projection (the study: one job per column).  The bound keeps the column's type (Q22)."""
    cols = [c for c in (cols or panel.money()) if c in df.columns]
    if not cols:
        return df
    caps = _p99_caps(df, cols, q, accuracy)
    return df.withColumns({c: F.when(qcol(c) > v, v).otherwise(qcol(c)) for c, v in caps.items()})


def clean_accounts(df: DataFrame, accuracy: int | None = DEFAULT_ACCURACY, panel: PeriodPanel = DEFAULT_PANEL) -> DataFrame:
    """Standard clean = EDUCATION / MARRIAGE recode + P99 winsorising of the
    money columns that exist (percentiles from the input frame)."""
    out = recode(df, "EDUCATION", EDUCATION_RECODE)
    out = recode(out, "MARRIAGE", MARRIAGE_RECODE)
    cols = [c for c in panel.money() if c in df.columns]
    if not cols:
        return out
    caps = _p99_caps(df, cols, 0.99, accuracy)
    return out.withColumns({c: F.when(qcol(c) > v, v).otherwise(qcol(c)) for c, v in caps.items()})


# ---------------------------------------------------------------- consistency rules
def default_rules(df: DataFrame, label: str = LABEL) -> list:
    """C17-C21 as (rule, predicate, in_summary).  Payment > 2x bill is reported
    but not listed as an issue (as in the study)."""
    cols = set(df.columns)
    rules = []
    if "AGE" in cols:
        rules.append(("unrealistic_age", (F.col("AGE") < 18) | (F.col("AGE") > 100), True))
    if {"LIMIT_BAL", "BILL_AMT1"} <= cols:
        rules.append(("bill_over_150pct_limit", (F.col("BILL_AMT1") > F.col("LIMIT_BAL") * 1.5)
                      & (F.col("LIMIT_BAL") > 0), True))
    for m in (1, 2, 3):
        b, p = f"BILL_AMT{m}", f"PAY_AMT{m}"
        if {b, p} <= cols:
            rules.append((f"payment_over_200pct_bill_m{m}", (F.col(p) > F.col(b) * 2) & (F.col(b) > 0), False))
    if {"PAY_0", "PAY_AMT1"} <= cols:
        rules.append(("paid_duly_zero_payment", (F.col("PAY_0") == -1) & (F.col("PAY_AMT1") == 0), True))
    if label in cols:
        rules.append(("invalid_label", ~qcol(label).isin([0, 1]), True))
    return rules


def consistency_report(df: DataFrame, rules=None) -> DataFrame:
    """All rules in one pass -> (rule, violations, pct, listed_issue)."""
    rules = rules if rules is not None else default_rules(df)
    total = F.count(F.lit(1))
    return long_form(df, {name: {"violations": F.count_if(pred), "pct": pct(F.count_if(pred), total),
                                 "listed_issue": F.lit(listed)} for name, pred, listed in rules},
                     key="rule")


def rule_values(df: DataFrame, predicate: Column, col: str) -> DataFrame:
    """Distinct offending values of one rule, ordered (e.g. the unrealistic ages)."""
    return df.where(predicate).select(qcol(col)).distinct().orderBy(qcol(col))

