"""DuckDB SQL twins, one per registered query (same keys, same column names).

Conventions: exponent literals (``5e-1``) for DOUBLE constants; integer sums
cast to BIGINT (DuckDB widens them to HUGEINT); averages / deviations /
correlations rounded to 6 digits on both sides; exact percentiles are
``quantile_disc`` (equal to Spark ``percentile_approx`` at accuracy 1e6);
``NULLIF`` where Spark uses ``try_divide`` (DuckDB yields inf on x/0).
"""

from oracle.base import ACCOUNTS_CTE, DIRTY_CTE, with_ctes
from oracle.features import BI, PA, ST, features_ctes

LABEL = "default_next_month"
STATUS = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
BILLS = [f"BILL_AMT{i}" for i in range(1, 7)]
PAYS = [f"PAY_AMT{i}" for i in range(1, 7)]
ACC_TYPES = ([("ID", "bigint"), ("LIMIT_BAL", "bigint"), ("SEX", "int"), ("EDUCATION", "int"), ("MARRIAGE", "int"),
              ("AGE", "int")] + [(c, "int") for c in STATUS] + [(c, "bigint") for c in BILLS + PAYS]
             + [(LABEL, "int")])
DIRTY_TYPES = ACC_TYPES + [("segment", "string")]
MONEY = ["LIMIT_BAL"] + BILLS + PAYS
NUMERIC_FEATURES = ["PAYMENT_TREND_SLOPE", "PAYMENT_STATUS_VOLATILITY", "MAX_PAYMENT_DELAY", "MIN_PAYMENT_DELAY",
                    "PAYMENT_DELAY_RANGE", "RECENT_AVG_DELAY", "HISTORICAL_AVG_DELAY", "PAYMENT_IMPROVEMENT_SCORE",
                    "RECOVERY_INSTANCES", "BILL_TREND_SLOPE", "BILL_AMOUNT_VOLATILITY", "DEBT_ACCUMULATION_RATE",
                    "AVG_BILL_AMOUNT", "AVG_PAYMENT_EFFICIENCY", "PAYMENT_EFFICIENCY_TREND",
                    "PAYMENT_CONSISTENCY_SCORE", "AVG_PAYMENT_AMOUNT", "CREDIT_UTILIZATION_RATIO", "CREDIT_BUFFER",
                    "CREDIT_UTILIZATION_TREND", "TEMPORAL_RISK_SCORE"]

A = [ACCOUNTS_CTE]
D = [ACCOUNTS_CTE, DIRTY_CTE]
FT = [ACCOUNTS_CTE] + features_ctes()


def q(body, ctes):
    return with_ctes(body, *ctes)


def union(parts):
    return "\nUNION ALL\n".join(parts)


def r6(x):
    return f"round({x}, 6)"


SQL = {}

# ---------------------------------------------------------------- sources / fixtures
SQL["accounts"] = q("SELECT * FROM accounts", A)
SQL["accounts_dirty"] = q("SELECT * FROM accounts_dirty", D)
SQL["sample_rows"] = q("SELECT * FROM accounts ORDER BY md5(CAST(ID AS VARCHAR)), ID LIMIT 200", A)

# ---------------------------------------------------------------- features / flagship
SQL["features"] = q("SELECT * FROM feat", FT)


def pivot_rate_sql(group, src):
    return f"""SELECT {group}, count(*) FILTER (WHERE {LABEL} = 0) AS "0", count(*) FILTER (WHERE {LABEL} = 1) AS "1",
  count(*) FILTER (WHERE {LABEL} = 0) + count(*) FILTER (WHERE {LABEL} = 1) AS total,
  CASE WHEN count(*) FILTER (WHERE {LABEL} = 0) + count(*) FILTER (WHERE {LABEL} = 1) > 0
       THEN count(*) FILTER (WHERE {LABEL} = 1) / (count(*) FILTER (WHERE {LABEL} = 0) + count(*) FILTER (WHERE {LABEL} = 1)) * 100
       ELSE 0e0 END AS default_rate
FROM {src} GROUP BY {group}"""


SQL["risk_category_default_rate"] = q(pivot_rate_sql("RISK_SCORE_CATEGORY", "feat"), FT)

# ---------------------------------------------------------------- profiling (B)
SQL["table_shape"] = q(f"SELECT count(*) AS n_rows, {len(DIRTY_TYPES)} AS n_columns, count(*) * {len(DIRTY_TYPES)} AS n_cells "
                       "FROM accounts_dirty", D)
SQL["null_counts"] = q(union([
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100 AS null_pct FROM accounts_dirty" for c, _ in DIRTY_TYPES]), D)
_all_dirty = ", ".join(c for c, _ in DIRTY_TYPES)
SQL["duplicate_count"] = q(f"""SELECT CAST(COALESCE(sum(c), 0) AS BIGINT) AS total_records, count(*) AS distinct_records,
  CAST(COALESCE(sum(c - 1), 0) AS BIGINT) AS duplicate_records
FROM (SELECT count(*) AS c FROM accounts_dirty GROUP BY {_all_dirty}) g""", D)


def _profile_row(c, t):
    code = c in ("SEX", "EDUCATION", "MARRIAGE") or "PAY_" in c
    num = t != "string"
    dist = (f"CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)" if code
            else "CAST(NULL AS BIGINT)")
    mn = f"CAST(min({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"
    mx = f"CAST(max({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"
    return (f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
            f"{dist} AS distinct_count, {mn} AS min_value, {mx} AS max_value FROM accounts_dirty")


SQL["column_profile"] = q(union([_profile_row(c, t) for c, t in DIRTY_TYPES]), D)
SQL["describe_columns"] = q(union([
    f"SELECT '{c}' AS column_name, count({c}) AS count, {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS stddev, "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM accounts_dirty"
    for c in ("LIMIT_BAL", "AGE", LABEL)]), D)
SQL["quality_report"] = q(union([
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"count(*) AS total_records, {len(DIRTY_TYPES)} AS total_columns, "
    f"(SELECT CAST(COALESCE(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM accounts_dirty GROUP BY {_all_dirty}) g) "
    f"AS duplicate_records FROM accounts_dirty" for c, t in DIRTY_TYPES]), D)
SQL["low_variance"] = q(union([
    f"SELECT '{c}' AS column_name, COALESCE(var_samp(CAST({c} AS DOUBLE)) < 1e-10, true) AS low_variance, "
    f"CASE WHEN var_samp(CAST({c} AS DOUBLE)) > 0 THEN round(log10(var_samp(CAST({c} AS DOUBLE))), 6) END AS log10_variance FROM feat"
    for c in NUMERIC_FEATURES]), FT)
SQL["duplicate_keys"] = q("SELECT ID, count(*) AS count FROM accounts_dirty GROUP BY ID HAVING count(*) > 1", D)


def _contract_rows():
    valid = {"SEX": "1, 2", "EDUCATION": "1, 2, 3, 4", "MARRIAGE": "1, 2, 3", LABEL: "0, 1"}
    valid.update({c: "-2, -1, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9" for c in STATUS})
    kinds = {c: "int" for c in ["SEX", "EDUCATION", "MARRIAGE", LABEL] + STATUS}
    out = []
    for c, t in ACC_TYPES:
        kind = kinds.get(c, "numeric")
        ok = "true" if (kind == "numeric" or t in ("int", "bigint")) else "false"
        inv = f"count(*) FILTER (WHERE NOT ({c} IN ({valid[c]})))" if c in valid else "CAST(0 AS BIGINT)"
        out.append(f"SELECT '{c}' AS column_name, true AS present, '{t}' AS dtype, {ok} AS type_ok, "
                   f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, {inv} AS invalid_count FROM accounts_dirty")
    return out


SQL["contract_violations"] = q(union(_contract_rows()), D)

# ---------------------------------------------------------------- cleaning (C)
SQL["missing_policy"] = q(f"""SELECT *, CASE WHEN missing_count = 0 THEN 'None needed' WHEN missing_pct < 1 THEN 'Drop rows'
  WHEN missing_pct < 5 THEN 'Impute' WHEN missing_pct < 20 THEN 'Investigate' ELSE 'Consider drop' END AS action
FROM ({union([f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
              f"count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100 AS missing_pct FROM accounts_dirty"
              for c, _ in DIRTY_TYPES])}) m""", D)
SQL["drop_incomplete"] = q("SELECT * FROM accounts_dirty WHERE " + " AND ".join(f"{c} IS NOT NULL" for c, _ in DIRTY_TYPES), D)
SQL["retention"] = q("""SELECT (SELECT count(*) FROM accounts_dirty) AS records_before, (SELECT count(*) FROM clean) AS records_after,
  (SELECT count(*) FROM accounts_dirty) - (SELECT count(*) FROM clean) AS records_dropped,
  (SELECT count(*) FROM clean) / (SELECT count(*) FROM accounts_dirty) * 100 AS retention_pct""",
                     D + ["clean AS (SELECT * FROM accounts_dirty WHERE " + " AND ".join(f"{c} IS NOT NULL" for c, _ in DIRTY_TYPES) + ")"])
SQL["drop_duplicates"] = q("SELECT DISTINCT * FROM accounts_dirty", D)
SQL["recode_codes"] = q("""SELECT * REPLACE (CASE WHEN EDUCATION IN (0, 5, 6) THEN 4 ELSE EDUCATION END AS EDUCATION,
  CASE WHEN MARRIAGE IN (0) THEN 3 ELSE MARRIAGE END AS MARRIAGE) FROM accounts""", A)
SQL["validate_status_codes"] = q("""SELECT PAY_0 AS code, count(*) AS count, count(*) / (SELECT count(*) FROM accounts) * 100 AS pct,
  COALESCE(PAY_0 IN (-2, -1, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9), false) AS valid FROM accounts GROUP BY PAY_0""", A)
SQL["clamp_status_codes"] = q("SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN {c} < -2 THEN -1 WHEN {c} > 9 THEN 9 ELSE {c} END AS {c}" for c in STATUS) + ") FROM accounts", A)


def _neg_action(c):
    return "Keep (credit)" if c.startswith("BILL_AMT") else ("Investigate" if c.startswith("PAY_AMT") else "Set to 0")


SQL["negative_report"] = q(union([
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} < 0) AS negative_count, "
    f"count(*) FILTER (WHERE {c} < 0) / count(*) * 100 AS negative_pct, "
    f"CASE WHEN count(*) FILTER (WHERE {c} < 0) > 0 THEN '{_neg_action(c)}' ELSE 'None needed' END AS action "
    f"FROM accounts_dirty" for c in MONEY]), D)


def _treat_negatives_sql(src):
    parts = []
    for c in MONEY:
        a = _neg_action(c)
        if a == "Keep (credit)":
            continue
        gate = "true" if a == "Set to 0" else f"(SELECT count(*) FILTER (WHERE {c} < 0) / count(*) * 100 < 1 FROM {src})"
        parts.append(f"CASE WHEN {gate} AND {c} < 0 THEN CAST(0 AS BIGINT) ELSE {c} END AS {c}")
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM {src}"


SQL["treat_negatives"] = q(_treat_negatives_sql("accounts_dirty"), D)


def _outlier_stats_cte(src, name="ostats"):
    cols = ", ".join(
        f"CAST(quantile_disc({c}, 1e-2) AS DOUBLE) AS p1_{c}, CAST(quantile_disc({c}, 25e-2) AS DOUBLE) AS q1_{c}, "
        f"CAST(quantile_disc({c}, 75e-2) AS DOUBLE) AS q3_{c}, CAST(quantile_disc({c}, 99e-2) AS DOUBLE) AS p99_{c}"
        for c in MONEY)
    return f"{name} AS (SELECT {cols}, count(*) AS n FROM {src})"


def _outlier_report_sql(src, stats="ostats"):
    rows = []
    for c in MONEY:
        lo = f"(q1_{c} - 3e0 * (q3_{c} - q1_{c}))"
        hi = f"(q3_{c} + 3e0 * (q3_{c} - q1_{c}))"
        cnt = f"(SELECT count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) FROM {src}, {stats})"
        rows.append(f"SELECT '{c}' AS column_name, p1_{c} AS p1, p99_{c} AS p99, q1_{c} AS q1, q3_{c} AS q3, "
                    f"{lo} AS lower_bound, {hi} AS upper_bound, {cnt} AS outliers, {cnt} / n * 100 AS outlier_pct FROM {stats}")
    return union(rows)


SQL["outlier_report"] = q(_outlier_report_sql("accounts_dirty"), D + [_outlier_stats_cte("accounts_dirty")])


def _cap_sql(src, rep="orep"):
    parts = [f"CASE WHEN (SELECT outliers > 0 AND outlier_pct > 1e-1 FROM {rep} WHERE column_name = '{c}') "
             f"AND {c} > (SELECT p99 FROM {rep} WHERE column_name = '{c}') "
             f"THEN CAST((SELECT p99 FROM {rep} WHERE column_name = '{c}') AS BIGINT) ELSE {c} END AS {c}" for c in MONEY]
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM {src}"


SQL["cap_outliers"] = q(_cap_sql("accounts_dirty"),
                        D + [_outlier_stats_cte("accounts_dirty"), f"orep AS ({_outlier_report_sql('accounts_dirty')})"])


def _winsor_sql(src, recode=False):
    caps = ", ".join(f"quantile_disc({c}, 99e-2) AS cap_{c}" for c in MONEY)
    parts = [f"CASE WHEN {c} > cap_{c} THEN cap_{c} ELSE {c} END AS {c}" for c in MONEY]
    if recode:
        parts += ["CASE WHEN EDUCATION IN (0, 5, 6) THEN 4 ELSE EDUCATION END AS EDUCATION",
                  "CASE WHEN MARRIAGE IN (0) THEN 3 ELSE MARRIAGE END AS MARRIAGE"]
    return f"SELECT s.* REPLACE ({', '.join(parts)}) FROM {src} s, (SELECT {caps} FROM {src}) caps"


SQL["winsorize"] = q(_winsor_sql("accounts"), A)
SQL["clean_accounts"] = q(_winsor_sql("accounts", recode=True), A)


def _rules_sql(src):
    rules = [("unrealistic_age", "AGE < 18 OR AGE > 100", "true"),
             ("bill_over_150pct_limit", "BILL_AMT1 > LIMIT_BAL * 15e-1 AND LIMIT_BAL > 0", "true")]
    rules += [(f"payment_over_200pct_bill_m{m}", f"PAY_AMT{m} > BILL_AMT{m} * 2 AND BILL_AMT{m} > 0", "false")
              for m in (1, 2, 3)]
    rules += [("paid_duly_zero_payment", "PAY_0 = -1 AND PAY_AMT1 = 0", "true"),
              ("invalid_label", f"NOT ({LABEL} IN (0, 1))", "true")]
    return union([f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {p}) AS violations, "
                  f"count(*) FILTER (WHERE {p}) / count(*) * 100 AS pct, {listed} AS listed_issue FROM {src}"
                  for n, p, listed in rules])


SQL["consistency_report"] = q(_rules_sql("accounts_dirty"), D)
SQL["unrealistic_ages"] = q("SELECT DISTINCT AGE FROM accounts_dirty WHERE AGE < 18 OR AGE > 100", D)

# ---------------------------------------------------------------- distributions / stats (D)
SQL["education_distribution"] = q("""SELECT EDUCATION AS value, count(*) AS count, count(*) / (SELECT count(*) FROM accounts) * 100 AS pct,
  CASE EDUCATION WHEN 1 THEN 'Graduate School' WHEN 2 THEN 'University' WHEN 3 THEN 'High School' WHEN 4 THEN 'Others'
       ELSE 'Code ' || CAST(EDUCATION AS VARCHAR) END AS label FROM accounts GROUP BY EDUCATION""", A)
SQL["class_balance"] = q(f"""SELECT n, n_default, n_no_default, n_default / n * 100 AS default_rate,
  n_no_default / NULLIF(n_default, 0) AS ratio,
  CASE WHEN n_default / n * 100 < 10 THEN 'Highly imbalanced' WHEN n_default / n * 100 > 40 THEN 'High default rate'
       ELSE 'Reasonably balanced' END AS note,
  n_default / n * 100 >= 30 AND n_default / n * 100 <= 70 AS balanced_30_70
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {LABEL} = 1) AS n_default,
             count(*) FILTER (WHERE {LABEL} = 0) AS n_no_default FROM accounts) t""", A)
SQL["numeric_stats"] = q(union([
    f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, {r6(f'avg({c})')} AS mean, "
    f"CAST(quantile_disc({c}, 5e-1) AS DOUBLE) AS median, {r6(f'stddev_samp({c})')} AS stddev FROM accounts"
    for c in ("LIMIT_BAL", "AGE")]), A)


def _band_sql(expr, src, ctes, name="band"):
    return q(f"SELECT {expr} AS {name}, count(*) AS count, count(*) / (SELECT count(*) FROM {src}) * 100 AS pct "
             f"FROM {src} GROUP BY 1", ctes)


SQL["limit_bands"] = _band_sql("CASE WHEN LIMIT_BAL < 50000 THEN '< 50K' WHEN LIMIT_BAL < 100000 THEN '50K-100K' "
                               "WHEN LIMIT_BAL < 200000 THEN '100K-200K' WHEN LIMIT_BAL < 500000 THEN '200K-500K' "
                               "ELSE '>= 500K' END", "accounts", A)
SQL["age_bands"] = _band_sql("CASE WHEN AGE < 30 THEN '< 30' WHEN AGE < 40 THEN '30-39' WHEN AGE < 50 THEN '40-49' "
                             "WHEN AGE < 60 THEN '50-59' ELSE '>= 60' END", "accounts", A)
_MEANING = ("CASE code WHEN -2 THEN 'No consumption' WHEN -1 THEN 'Pay duly' WHEN 0 THEN 'Use of revolving credit' "
            "WHEN 1 THEN 'Payment delay for one month' WHEN 2 THEN 'Payment delay for two months' "
            "WHEN 3 THEN 'Payment delay for three months' WHEN 4 THEN 'Payment delay for four months' "
            "WHEN 5 THEN 'Payment delay for five months' WHEN 6 THEN 'Payment delay for six months' "
            "WHEN 7 THEN 'Payment delay for seven months' WHEN 8 THEN 'Payment delay for eight months' "
            "WHEN 9 THEN 'Payment delay for nine months and above' ELSE 'Unknown ' || CAST(code AS VARCHAR) END")
_STATUS_LONG = union([f"SELECT {m} AS period, {c} AS code FROM accounts" for m, c in zip(range(1, 7), STATUS)])
SQL["status_distribution"] = q(f"""SELECT period, code, count(*) AS count, count(*) / (SELECT count(*) FROM accounts) * 100 AS pct,
  {_MEANING} AS meaning FROM ({_STATUS_LONG}) l GROUP BY period, code""", A)


def _period_stats_sql(cols, src="accounts", scale=None):
    def v(c):
        return f"({c} / {scale})" if scale else c
    return union([f"SELECT '{c}' AS column_name, {r6(f'avg({v(c)})')} AS mean, "
                  f"CAST(quantile_disc({v(c)}, 5e-1) AS DOUBLE) AS median, {r6(f'stddev_samp({v(c)})')} AS std, "
                  f"CAST(min({v(c)}) AS DOUBLE) AS min, CAST(max({v(c)}) AS DOUBLE) AS max FROM {src}" for c in cols])


SQL["status_stats"] = q(_period_stats_sql(STATUS), A)
SQL["bill_payment_stats"] = q(_period_stats_sql(BILLS + PAYS, scale="1e3"), A)
_all_le0 = " AND ".join(f"{c} <= 0" for c in STATUS)
_any_gt0 = " OR ".join(f"{c} > 0" for c in STATUS)
_any_ge3 = " OR ".join(f"{c} >= 3" for c in STATUS)
SQL["panel_patterns"] = q(f"""SELECT n, always_on_time, ever_late, ever_3plus_late, always_on_time / n * 100 AS always_on_time_pct,
  ever_late / n * 100 AS ever_late_pct, ever_3plus_late / n * 100 AS ever_3plus_late_pct
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {_all_le0}) AS always_on_time, count(*) FILTER (WHERE {_any_gt0}) AS ever_late,
             count(*) FILTER (WHERE {_any_ge3}) AS ever_3plus_late FROM accounts) t""", A)
SQL["period_efficiency"] = q(union([
    f"SELECT 'month_{m}' AS month, {r6(f'avg(CASE WHEN BILL_AMT{m} > 0 THEN PAY_AMT{m} / BILL_AMT{m} ELSE 0e0 END)')} "
    f"AS mean_efficiency, {r6(f'quantile_disc(CASE WHEN BILL_AMT{m} > 0 THEN PAY_AMT{m} / BILL_AMT{m} ELSE 0e0 END, 5e-1)')} "
    f"AS median_efficiency FROM accounts" for m in range(1, 7)]), A)
SQL["utilisation"] = q(f"SELECT {r6('avg(CASE WHEN LIMIT_BAL > 0 THEN BILL_AMT1 / LIMIT_BAL ELSE 0e0 END)')} "
                       "AS mean_utilisation FROM accounts", A)
SQL["zero_payments"] = q(union([
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} = 0) AS zero_count, "
    f"count(*) FILTER (WHERE {c} = 0) / count(*) * 100 AS zero_pct FROM accounts" for c in PAYS]), A)
SQL["rate_by_education"] = q(f"SELECT EDUCATION, count(*) AS n, {r6(f'avg({LABEL}) * 100')} AS rate FROM accounts GROUP BY EDUCATION", A)
SQL["utilisation_by_label"] = q(f"SELECT {LABEL} AS label, {r6('avg(CREDIT_UTILIZATION_RATIO)')} AS mean FROM feat GROUP BY {LABEL}", FT)
SQL["utilisation_percentiles"] = q(union([
    f"SELECT {p}e0 AS prob, CAST(quantile_disc(CREDIT_UTILIZATION_RATIO, {p}e0) AS DOUBLE) AS value FROM feat"
    for p in ("0.1", "0.25", "0.5", "0.75", "0.9")]), FT)
SQL["high_utilisation_count"] = q("""SELECT count(*) FILTER (WHERE CREDIT_UTILIZATION_RATIO > 8e-1) AS n,
  count(*) FILTER (WHERE CREDIT_UTILIZATION_RATIO > 8e-1) / count(*) * 100 AS pct FROM feat""", FT)

# ---------------------------------------------------------------- correlation (R)
CORR_COLS = [c for c, _ in ACC_TYPES if c not in ("ID", LABEL)]


def _rexpr(a, b):
    return (f"covar_pop(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) / NULLIF(stddev_pop(CAST({a} AS DOUBLE)) * "
            f"stddev_pop(CAST({b} AS DOUBLE)), 0)")


def _pairs_sql(pairs, src, complete=False, pairwise_label=None):
    """All pairwise r in ONE aggregate, zipped back to rows with parallel unnest."""
    if complete:
        cols = list(dict.fromkeys(c for p in pairs for c in p))
        src = f"(SELECT * FROM {src} WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols) + ")"
        exprs = [_rexpr(a, b) for a, b in pairs]
    else:  # pairwise-complete rows, as the Spark label-correlation operator
        exprs = [_rexpr(f"CASE WHEN {b} IS NOT NULL THEN {a} END", f"CASE WHEN {a} IS NOT NULL THEN {b} END")
                 for a, b in pairs]
    la = ", ".join(f"'{a}'" for a, _ in pairs)
    lb = ", ".join(f"'{b}'" for _, b in pairs)
    return (f"SELECT unnest([{la}]) AS a, unnest([{lb}]) AS b, unnest([{', '.join(exprs)}]) AS r "
            f"FROM {src} t")


def _strength(x):
    return (f"CASE WHEN {x} >= 3e-1 THEN 'Strong' WHEN {x} >= 1e-1 THEN 'Moderate' WHEN {x} >= 5e-2 THEN 'Weak' "
            f"ELSE 'Very Weak' END")


_CORRS = f"SELECT a AS column_name, r FROM ({_pairs_sql([(c, LABEL) for c in CORR_COLS], 'accounts')}) p"
SQL["label_correlations"] = q(f"""SELECT column_name, round(r, 6) AS r, round(abs(r), 6) AS abs_r, {_strength('abs(r)')} AS strength
FROM ({_CORRS}) c ORDER BY abs(r) DESC NULLS LAST, column_name LIMIT 15""", A)
SQL["correlation_strength"] = q(f"SELECT {_strength('abs(r)')} AS strength, count(*) AS count FROM ({_CORRS}) c GROUP BY 1", A)
SQL["correlation_extremes"] = q(f"""SELECT arg_max(column_name, r) FILTER (WHERE r > 0) AS strongest_positive,
  round(max(r) FILTER (WHERE r > 0), 6) AS positive_r, arg_min(column_name, r) FILTER (WHERE r < 0) AS strongest_negative,
  round(min(r) FILTER (WHERE r < 0), 6) AS negative_r FROM ({_CORRS}) c""", A)
SQL["status_correlation_matrix"] = q(
    f"SELECT a, b, round(r, 6) AS r FROM ({_pairs_sql([(a, b) for i, a in enumerate(STATUS) for b in STATUS[i + 1:]], 'accounts', complete=True)}) m", A)
_MATRIX_COLS = NUMERIC_FEATURES + [LABEL]
_PAIRS = _pairs_sql([(a, b) for i, a in enumerate(_MATRIX_COLS) for b in _MATRIX_COLS[i + 1:]], "feat", complete=True)
SQL["high_correlation_pairs"] = q(f"SELECT a, b, round(r, 6) AS r FROM ({_PAIRS}) m WHERE abs(r) > 8e-1", FT)

# ---------------------------------------------------------------- feature band reports (F)
_bands = {
    "band_payment_trend": ("PAYMENT_TREND_SLOPE", [(">", "1", "Strongly Improving"), (">", "2e-1", "Improving"),
                                                   (">", "-2e-1", "Stable"), (">", "-1", "Deteriorating")],
                           "Strongly Deteriorating"),
    "band_improvement": ("PAYMENT_IMPROVEMENT_SCORE", [(">", "2", "Significant Improvement"), (">", "5e-1", "Moderate Improvement"),
                                                      (">", "-5e-1", "Stable"), (">", "-2", "Moderate Deterioration")],
                         "Significant Deterioration"),
    "band_recovery": ("RECOVERY_INSTANCES", [("=", "0", "No recovery"), ("<=", "2", "Limited recovery"),
                                             ("<=", "4", "Good recovery")], "Excellent recovery"),
    "band_bill_trend": ("BILL_TREND_SLOPE", [(">", "5000", "Rapidly Increasing"), (">", "1000", "Increasing"),
                                             (">", "-1000", "Stable"), (">", "-5000", "Decreasing")], "Rapidly Decreasing"),
    "band_efficiency": ("AVG_PAYMENT_EFFICIENCY", [(">=", "1e0", "Full Payment"), (">=", "8e-1", "High Efficiency"),
                                                  (">=", "5e-1", "Medium Efficiency"), (">=", "2e-1", "Low Efficiency")],
                        "Very Low Efficiency"),
    "band_efficiency_trend": ("PAYMENT_EFFICIENCY_TREND", [(">", "1e-1", "Improving Efficiency"),
                                                          (">", "-1e-1", "Stable Efficiency")], "Declining Efficiency"),
    "band_utilisation": ("CREDIT_UTILIZATION_RATIO", [("<=", "1e-1", "Very Low (≤10%)"), ("<=", "3e-1", "Low (10-30%)"),
                                                     ("<=", "5e-1", "Medium (30-50%)"), ("<=", "8e-1", "High (50-80%)"),
                                                     ("<=", "1e0", "Very High (80-100%)")], "Over Limit (>100%)"),
    "band_utilisation_trend": ("CREDIT_UTILIZATION_TREND", [(">", "1e-1", "Increasing Utilization"),
                                                           (">", "-1e-1", "Stable Utilization")], "Decreasing Utilization"),
}
for _k, (_c, _steps, _else) in _bands.items():
    _expr = "CASE " + " ".join(f"WHEN {_c} {op} {cut} THEN '{lab}'" for op, cut, lab in _steps) + f" ELSE '{_else}' END"
    SQL[_k] = _band_sql(_expr, "feat", FT)
SQL["behaviour_distribution"] = _band_sql("PAYMENT_BEHAVIOR_TYPE", "feat", FT)
SQL["risk_category_distribution"] = _band_sql("RISK_SCORE_CATEGORY", "feat", FT)
SQL["debt_report"] = q("""SELECT high_debt, high_debt / n * 100 AS high_debt_pct, debt_reduction, debt_reduction / n * 100 AS debt_reduction_pct
FROM (SELECT count(*) FILTER (WHERE DEBT_ACCUMULATION_RATE > 5e-1) AS high_debt,
             count(*) FILTER (WHERE DEBT_ACCUMULATION_RATE < -1e-1) AS debt_reduction, count(*) AS n FROM feat) t""", FT)
SQL["basic_utilisation_report"] = q("""SELECT round(avg(u), 6) AS avg_util, quantile_disc(u, 5e-1) AS median_util,
  quantile_disc(u, 9e-1) AS p90_util, count(*) FILTER (WHERE LIMIT_BAL > 0 AND AVG_BILL_AMOUNT / LIMIT_BAL > 8e-1) AS high_util
FROM (SELECT *, CASE WHEN LIMIT_BAL > 0 THEN AVG_BILL_AMOUNT / LIMIT_BAL ELSE 0 END AS u FROM feat) t""", FT)
SQL["buffer_report"] = q("""SELECT round(avg(CREDIT_BUFFER), 6) AS avg_buffer, quantile_disc(CREDIT_BUFFER, 25e-2) AS q1,
  quantile_disc(CREDIT_BUFFER, 5e-1) AS median, quantile_disc(CREDIT_BUFFER, 75e-2) AS q3,
  count(*) FILTER (WHERE CREDIT_BUFFER < 10000) AS low_buffer FROM feat""", FT)

# ---------------------------------------------------------------- evaluation on the score-as-model (G)
PRED = FT + ["pred AS (SELECT *, TEMPORAL_RISK_SCORE AS score, CASE WHEN TEMPORAL_RISK_SCORE >= 5e-1 THEN 1e0 ELSE 0e0 END "
             "AS prediction, TEMPORAL_RISK_SCORE AS prob_default FROM feat)"]
_CM = f"""SELECT count(*) FILTER (WHERE {LABEL} = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE {LABEL} = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE {LABEL} = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE {LABEL} = 1 AND prediction = 0) AS fn FROM pred"""
SQL["confusion_report"] = q(f"""SELECT tp, fp, tn, fn, COALESCE(tp / NULLIF(tp + fn, 0), 0e0) AS sensitivity,
  COALESCE(tn / NULLIF(tn + fp, 0), 0e0) AS specificity FROM ({_CM}) c""", PRED)
_AUC = f"""SELECT CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) * 2) AS auc
FROM (SELECT s, pos, neg, COALESCE(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT CAST(score AS DOUBLE) AS s, count(*) FILTER (WHERE {LABEL} = 1) AS pos,
                   count(*) FILTER (WHERE {LABEL} = 0) AS neg FROM pred WHERE score IS NOT NULL GROUP BY 1) g) w"""
SQL["classification_metrics"] = q(f"""SELECT round((tp + tn) / n, 9) AS accuracy,
  round(w0 * p0 + w1 * p1, 9) AS weighted_precision, round(w0 * r0 + w1 * r1, 9) AS weighted_recall,
  round(w0 * COALESCE(2 * p0 * r0 / NULLIF(p0 + r0, 0), 0e0) + w1 * COALESCE(2 * p1 * r1 / NULLIF(p1 + r1, 0), 0e0), 9) AS f1,
  round(({_AUC}), 9) AS auc
FROM (SELECT *, CAST(tp + fp + tn + fn AS DOUBLE) AS n,
        COALESCE(tp / NULLIF(tp + fp, 0), 0e0) AS p1, COALESCE(tp / NULLIF(tp + fn, 0), 0e0) AS r1,
        COALESCE(tn / NULLIF(tn + fn, 0), 0e0) AS p0, COALESCE(tn / NULLIF(tn + fp, 0), 0e0) AS r0,
        (tp + fn) / CAST(tp + fp + tn + fn AS DOUBLE) AS w1, (tn + fp) / CAST(tp + fp + tn + fn AS DOUBLE) AS w0
      FROM ({_CM}) c) m""", PRED)
SQL["model_grade"] = q(f"""SELECT 'TEMPORAL_RISK_SCORE' AS model, round(auc, 9) AS auc,
  CASE WHEN auc >= 85e-2 THEN 'Excellent' WHEN auc >= 75e-2 THEN 'Good' WHEN auc >= 65e-2 THEN 'Fair' ELSE 'Poor' END AS grade,
  true AS is_best FROM ({_AUC}) a""", PRED)
SQL["confidence_report"] = q("""SELECT prediction, count(*) AS n, count(*) FILTER (WHERE conf > 8e-1) AS high_confidence,
  count(*) FILTER (WHERE conf > 6e-1 AND conf <= 8e-1) AS medium_confidence, round(avg(conf), 6) AS mean_confidence
FROM (SELECT prediction, CASE WHEN prediction = 1 THEN prob_default ELSE 1 - prob_default END AS conf FROM pred) t
GROUP BY prediction""", PRED)
SQL["risk_performance"] = q(f"""SELECT RISK_SCORE_CATEGORY, count(*) AS total, CAST(sum({LABEL}) AS BIGINT) AS actual_defaults,
  sum(prediction) AS predicted_defaults, round(avg({LABEL}), 6) AS actual_default_rate,
  round(avg(prediction), 6) AS predicted_default_rate FROM pred GROUP BY RISK_SCORE_CATEGORY""", PRED)
SQL["segment_performance"] = q(f"""SELECT CUSTOMER_SEGMENT, total_customers, round(a, 6) AS actual_default_rate,
  round(p, 6) AS predicted_default_rate,
  CASE WHEN a < 15 THEN 'Healthy' WHEN a < 30 THEN 'Monitor' ELSE 'Alert' END AS status
FROM (SELECT CUSTOMER_SEGMENT, count(*) AS total_customers, avg({LABEL}) * 100 AS a, avg(prediction) * 100 AS p
  FROM pred GROUP BY CUSTOMER_SEGMENT) t""", PRED)
SQL["risk_distribution"] = q(f"""SELECT *, CASE WHEN default_rate < 10 THEN 'Low' WHEN default_rate < 25 THEN 'Medium'
  WHEN default_rate < 40 THEN 'High' ELSE 'Critical' END AS risk_level FROM ({pivot_rate_sql('RISK_SCORE_CATEGORY', 'pred')}) p""", PRED)


def _value_sql(by=None):
    g = f"{by}, " if by else ""
    return f"""SELECT {g}tp, fp, fn, tp * 3e-1 AS defaults_prevented, tp * 3e-1 * 5e4 AS gross_savings,
  (tp + fp) * 5e2 AS intervention_costs, tp * 3e-1 * 5e4 - (tp + fp) * 5e2 AS net_savings,
  fn * 3e-1 * 5e4 AS missed_savings,
  COALESCE((tp * 3e-1 * 5e4 - (tp + fp) * 5e2) / NULLIF((tp + fp) * 5e2, 0) * 100, 0e0) AS roi_pct
FROM (SELECT {g}count(*) FILTER (WHERE {LABEL} = 1 AND prediction = 1) AS tp,
             count(*) FILTER (WHERE {LABEL} = 0 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE {LABEL} = 1 AND prediction = 0) AS fn FROM pred {'GROUP BY ' + by if by else ''}) c"""


SQL["intervention_value"] = q(_value_sql(), PRED)
SQL["intervention_value_by_segment"] = q(_value_sql("CUSTOMER_SEGMENT"), PRED)
_U = "CAST(('0x' || substr(md5(CAST(ID AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296e0"
SQL["split_report"] = q(f"""SELECT split, count(*) AS n, round(avg({LABEL}) * 100, 6) AS default_rate,
  count(*) / (SELECT count(*) FROM accounts) * 100 AS share_pct
FROM (SELECT *, CASE WHEN {_U} < 7e-1 THEN 'train' WHEN {_U} < 85e-2 THEN 'validation' ELSE 'test' END AS split FROM accounts) t
GROUP BY split""", A)

# ---------------------------------------------------------------- chart data (V)
SQL["age_histogram"] = q("""SELECT bin, count(*) AS count, mn + (bin - 1) * ((mx - mn) / 25) AS lower, mn + bin * ((mx - mn) / 25) AS upper
FROM (SELECT CAST(LEAST(COALESCE(floor((CAST(AGE AS DOUBLE) - mn) * 25 / NULLIF(mx - mn, 0)), 0) + 1, 25) AS INT) AS bin, mn, mx
      FROM accounts, (SELECT CAST(min(AGE) AS DOUBLE) AS mn, CAST(max(AGE) AS DOUBLE) AS mx FROM accounts) m
      WHERE AGE IS NOT NULL) t GROUP BY bin, mn, mx""", A)
SQL["utilisation_histogram_by_label"] = q(f"""SELECT grp AS "group", bin, count(*) AS count,
  mn + (bin - 1) * ((mx - mn) / 30) AS lower, mn + bin * ((mx - mn) / 30) AS upper
FROM (SELECT {LABEL} AS grp, CAST(LEAST(COALESCE(floor((CREDIT_UTILIZATION_RATIO - mn) * 30 / NULLIF(mx - mn, 0)), 0) + 1, 30) AS INT) AS bin, mn, mx
      FROM feat, (SELECT min(CREDIT_UTILIZATION_RATIO) AS mn, max(CREDIT_UTILIZATION_RATIO) AS mx FROM feat) m
      WHERE CREDIT_UTILIZATION_RATIO IS NOT NULL) t GROUP BY grp, bin, mn, mx""", FT)
SQL["utilisation_scatter_sample"] = q(f"""SELECT ID, CREDIT_UTILIZATION_RATIO, LIMIT_BAL, {LABEL} FROM feat
ORDER BY md5(CAST(ID AS VARCHAR)), ID LIMIT 500""", FT)


# ---------------------------------------------------------------- full cleansing run
def _keep_cond(cols):
    return " AND ".join(f"({c} IS NOT NULL OR a_{c} <> 'Drop rows')" for c in cols) or "true"


def _missing_ctes(src="accounts_dirty"):
    """pol: one row of actions; fills: one row of medians / modes; tm: treated table."""
    names = [c for c, _ in DIRTY_TYPES]
    types = dict(DIRTY_TYPES)
    acts = ", ".join(
        f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) = 0 THEN 'None needed' "
        f"WHEN count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100 < 1 THEN 'Drop rows' "
        f"WHEN count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100 < 5 THEN 'Impute' "
        f"WHEN count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100 < 20 THEN 'Investigate' "
        f"ELSE 'Consider drop' END AS a_{c}" for c in names)
    fills = []
    for i, c in enumerate(names):
        prior = _keep_cond(names[:i])
        if types[c] == "string":
            fills.append(f"(SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM {src}, pol WHERE {prior} AND {c} IS NOT NULL "
                         f"GROUP BY {c}) m ORDER BY n DESC, v ASC LIMIT 1) AS f_{c}")
        else:
            fills.append(f"(SELECT quantile_disc({c}, 5e-1) FROM {src}, pol WHERE {prior}) AS f_{c}")
    repl = ", ".join(f"CASE WHEN a_{c} = 'Impute' THEN COALESCE({c}, CAST(f_{c} AS {types[c].upper()})) ELSE {c} END AS {c}"
                     for c in names)
    return [f"pol AS (SELECT {acts} FROM {src})",
            f"fills AS (SELECT {', '.join(fills)})",
            f"tm AS (SELECT {repl} FROM {src}, pol, fills WHERE {_keep_cond(names)})"]


SQL["treat_missing"] = q("SELECT * FROM tm", D + _missing_ctes())


def _cleanse_ctes():
    ctes = D + _missing_ctes()
    ctes.append("dd AS (SELECT DISTINCT * FROM tm)")
    ctes.append("rc AS (SELECT * REPLACE (CASE WHEN EDUCATION IN (0, 5, 6) THEN 4 ELSE EDUCATION END AS EDUCATION, "
                "CASE WHEN MARRIAGE IN (0) THEN 3 ELSE MARRIAGE END AS MARRIAGE) FROM dd)")
    negs = []
    for c in MONEY:
        a = _neg_action(c)
        cnt, pc = f"count(*) FILTER (WHERE {c} < 0)", f"count(*) FILTER (WHERE {c} < 0) / count(*) * 100"
        gate = (f"({cnt} > 0)" if a == "Set to 0" else f"({cnt} > 0 AND {pc} < 1)" if a == "Investigate" else "false")
        negs.append(f"{gate} AS z_{c}")
    ctes.append(f"ng AS (SELECT {', '.join(negs)} FROM rc)")
    ctes.append("nt AS (SELECT rc.* REPLACE (" + ", ".join(
        f"CASE WHEN z_{c} AND {c} < 0 THEN CAST(0 AS BIGINT) ELSE {c} END AS {c}" for c in MONEY) + ") FROM rc, ng)")
    ctes.append(_outlier_stats_cte("nt", "cst"))
    ctes.append(f"crep AS ({_outlier_report_sql('nt', 'cst')})")
    ctes.append("cap AS (" + _cap_sql("nt", "crep") + ")")
    ctes.append("cleansed AS (SELECT * REPLACE (" + ", ".join(
        f"CASE WHEN {c} < -2 THEN -1 WHEN {c} > 9 THEN 9 ELSE {c} END AS {c}" for c in STATUS) + ") FROM cap)")
    return ctes


SQL["cleanse"] = q("SELECT * FROM cleansed", _cleanse_ctes())


# ---------------------------------------------------------------- more profiling / statistics
# ---- fixed values: the study's feature categories ----
FEATURE_CATEGORIES = {
    "Payment Trends": ["PAYMENT_TREND_SLOPE", "PAYMENT_STATUS_VOLATILITY", "MAX_PAYMENT_DELAY",
                       "MIN_PAYMENT_DELAY", "PAYMENT_DELAY_RANGE"],
    "Temporal Segmentation": ["RECENT_AVG_DELAY", "HISTORICAL_AVG_DELAY", "PAYMENT_IMPROVEMENT_SCORE",
                              "RECOVERY_INSTANCES"],
    "Financial Analysis": ["BILL_TREND_SLOPE", "BILL_AMOUNT_VOLATILITY", "DEBT_ACCUMULATION_RATE",
                           "AVG_BILL_AMOUNT"],
    "Payment Efficiency": ["AVG_PAYMENT_EFFICIENCY", "PAYMENT_EFFICIENCY_TREND", "PAYMENT_CONSISTENCY_SCORE",
                           "AVG_PAYMENT_AMOUNT"],
    "Credit Utilization": ["CREDIT_UTILIZATION_RATIO", "CREDIT_BUFFER", "CREDIT_UTILIZATION_TREND"],
    "Behavioral Classification": ["PAYMENT_BEHAVIOR_TYPE", "TEMPORAL_RISK_LEVEL", "CUSTOMER_SEGMENT"],
    "Risk Scoring": ["TEMPORAL_RISK_SCORE", "RISK_SCORE_CATEGORY"],
}
# ---- end of fixed values ----


def _cat_row(cat, cols):
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
    num = [c for c in cols if c in NUMERIC_FEATURES]
    low = " + ".join(f"CAST(COALESCE(var_samp(CAST({c} AS DOUBLE)) < 1e-10, true) AS INTEGER)" for c in num) or "0"
    return (f"SELECT '{cat}' AS category, {len(cols)} AS variables, {len(cols)} AS available, "
            f"CAST({nulls} AS BIGINT) AS null_cells, CAST({low} AS INTEGER) AS low_variance FROM feat")


SQL["profile_by_category"] = q(union([_cat_row(k, v) for k, v in FEATURE_CATEGORIES.items()]), FT)
SQL["sample_values"] = q(union([
    f"SELECT '{c}' AS column_name, CAST(list_slice(list_sort(list_distinct(list({c}) FILTER (WHERE {c} IS NOT NULL))), 1, 3) AS VARCHAR[]) "
    f"AS sample FROM accounts_dirty" for c, _ in DIRTY_TYPES]), D)


def _summary(src):
    nulls = " + ".join(f"CAST(count(*) FILTER (WHERE {c} IS NULL) > 0 AS INTEGER)" for c, _ in DIRTY_TYPES)
    cols = ", ".join(c for c, _ in DIRTY_TYPES)
    return (f"SELECT count(*) AS total_records, {nulls} AS columns_with_missing, "
            f"(SELECT CAST(COALESCE(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {src} GROUP BY {cols}) g) "
            f"AS duplicate_records FROM {src}")


_QD = _cleanse_ctes() + [f"sb AS ({_summary('accounts_dirty')})", f"sa AS ({_summary('cleansed')})"]
SQL["quality_diff"] = q("""SELECT 'total_records' AS metric, CAST(sb.total_records AS BIGINT) AS before, CAST(sa.total_records AS BIGINT) AS after,
  CAST(sa.total_records - sb.total_records AS BIGINT) AS improvement FROM sb, sa
UNION ALL SELECT 'columns_with_missing', CAST(sb.columns_with_missing AS BIGINT), CAST(sa.columns_with_missing AS BIGINT),
  CAST(sb.columns_with_missing - sa.columns_with_missing AS BIGINT) FROM sb, sa
UNION ALL SELECT 'duplicate_records', sb.duplicate_records, sa.duplicate_records,
  sb.duplicate_records - sa.duplicate_records FROM sb, sa""", _QD)
SQL["quality_score"] = q("""SELECT *, CASE WHEN quality_score >= 4 THEN 'Excellent' WHEN quality_score >= 3 THEN 'Good'
  WHEN quality_score >= 2 THEN 'Fair' ELSE 'Needs Improvement' END AS rating FROM (
  SELECT CAST((sa.columns_with_missing = 0) AS INTEGER) + CAST((sa.duplicate_records = 0) AS INTEGER)
       + COALESCE(CAST(CAST(sa.total_records AS DOUBLE) / NULLIF(sb.total_records, 0) >= 95e-2 AS INTEGER), 0) + 1 + 1
       AS quality_score, 5 AS max_score, CAST(sa.total_records AS DOUBLE) / NULLIF(sb.total_records, 0) AS retention_rate
  FROM sb, sa) t""", _QD)
SQL["above_own_percentile"] = q("""SELECT count(*) FILTER (WHERE CREDIT_UTILIZATION_RATIO >= p) AS n,
  count(*) FILTER (WHERE CREDIT_UTILIZATION_RATIO >= p) / count(*) * 100 AS pct
FROM feat, (SELECT quantile_disc(CREDIT_UTILIZATION_RATIO, 9e-1) AS p FROM feat) q""", FT)


# ---------------------------------------------------------------- more chart data (V1, V2, V5)
def _labelled_dist(col, mapping, src="accounts", ctes=A):
    case = " ".join(f"WHEN {k} THEN '{v}'" for k, v in mapping.items())
    return q(f"""SELECT {col} AS value, count(*) AS count, count(*) / (SELECT count(*) FROM {src}) * 100 AS pct,
  CASE {col} {case} ELSE 'Code ' || CAST({col} AS VARCHAR) END AS label FROM {src} GROUP BY {col}""", ctes)


SQL["sex_distribution"] = _labelled_dist("SEX", {1: "Male", 2: "Female"})
SQL["marriage_distribution"] = _labelled_dist("MARRIAGE", {1: "Married", 2: "Single", 3: "Others"})
for _k, _g in [("rate_by_segment", "CUSTOMER_SEGMENT"), ("rate_by_behaviour", "PAYMENT_BEHAVIOR_TYPE"),
               ("rate_by_sex", "SEX"), ("rate_by_latest_status", "PAY_0")]:
    SQL[_k] = q(f"SELECT {_g}, count(*) AS n, round(avg({LABEL}) * 100, 6) AS rate FROM feat GROUP BY {_g}", FT)


def _hist_sql(expr, bins, src, ctes, by=None):
    g_sel = f"{by} AS grp, " if by else ""
    g_out = 'grp AS "group", ' if by else ""
    g_grp = "grp, " if by else ""
    return q(f"""SELECT {g_out}bin, count(*) AS count, mn + (bin - 1) * ((mx - mn) / {bins}) AS lower, mn + bin * ((mx - mn) / {bins}) AS upper
FROM (SELECT {g_sel}CAST(LEAST(COALESCE(floor((v - mn) * {bins} / NULLIF(mx - mn, 0)), 0) + 1, {bins}) AS INT) AS bin, mn, mx
      FROM (SELECT *, CAST({expr} AS DOUBLE) AS v FROM {src}) s,
           (SELECT min(CAST({expr} AS DOUBLE)) AS mn, max(CAST({expr} AS DOUBLE)) AS mx FROM {src}) m
      WHERE v IS NOT NULL) t GROUP BY {g_grp}bin, mn, mx""", ctes)


SQL["limit_histogram"] = _hist_sql("LIMIT_BAL / 1e3", 30, "accounts", A)
SQL["improvement_histogram"] = _hist_sql("PAYMENT_IMPROVEMENT_SCORE", 40, "feat", FT)
SQL["score_histogram_by_label"] = _hist_sql("TEMPORAL_RISK_SCORE", 30, "feat", FT, by=LABEL)
SQL["efficiency_histogram_by_label"] = _hist_sql("AVG_PAYMENT_EFFICIENCY", 30, "feat", FT, by=LABEL)
SQL["duplicate_key_examples"] = q("""SELECT ID, count(*) AS count FROM accounts_dirty GROUP BY ID HAVING count(*) > 1
ORDER BY ID LIMIT 5""", D)


# ---------------------------------------------------------------- what holds for any fitted model
_SPLIT = f"CASE WHEN {_U} < 7e-1 THEN 'train' WHEN {_U} < 85e-2 THEN 'validation' ELSE 'test' END"
_WHOLE = " AND ".join(f"{c} IS NOT NULL" for c in NUMERIC_FEATURES)  # rows with a NULL feature are skipped (G5)


def _checks_row(model, split):
    tree = model in ("Random Forest", "Gradient Boosting")
    one, hundred = ("CAST(1 AS DOUBLE)", "CAST(100 AS DOUBLE)") if tree else ("CAST(NULL AS DOUBLE)",) * 2
    return (f"SELECT '{model}' AS model, '{split}' AS split, count(*) AS n, count(*) AS n_sum_1, count(*) AS n_class, "
            f"{one} AS importance_sum, {hundred} AS category_pct FROM feat WHERE {_WHOLE} AND {_SPLIT} = '{split}'")


SQL["model_checks"] = q(union([_checks_row(m, s) for m in ("Logistic Regression", "Random Forest", "Gradient Boosting", "Neural Network")
                               for s in ("validation", "test")]), FT)
SQL["cross_validated_model"] = q(f"""SELECT count(*) AS n_test, count(*) FILTER (WHERE {LABEL} = 1) AS n_default, CAST(0 AS DOUBLE) AS accuracy_difference,
  count(*) AS n_in_risk_groups FROM feat WHERE {_WHOLE} AND {_SPLIT} = 'test'""", FT)
for _c, _v in [*[(c, "-2, -1, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9") for c in STATUS[1:]], ("SEX", "1, 2"), ("EDUCATION", "1, 2, 3, 4"), ("MARRIAGE", "1, 2, 3")]:
    SQL[f"validate_codes_{_c.lower()}"] = q(f"""SELECT {_c} AS code, count(*) AS count, count(*) / (SELECT count(*) FROM accounts) * 100 AS pct,
  COALESCE({_c} IN ({_v}), false) AS valid FROM accounts GROUP BY {_c}""", A)


# ---------------------------------------------------------------- panels with gaps, categories by name
SQL["features_dirty"] = q("SELECT * FROM feat", D + features_ctes("accounts_dirty"))
_GONE = ("PAY_6", "PAY_3", "BILL_AMT1", "BILL_AMT5", "PAY_AMT2", "PAY_AMT4")
_FEW = tuple(c for c in ST + BI + PA if c not in ("PAY_0", "PAY_5", "BILL_AMT2", "BILL_AMT4"))
for _name, _gone in (("features_reduced", _GONE), ("features_few_months", _FEW)):
    SQL[_name] = q("SELECT * FROM feat", D + [f"part AS (SELECT * EXCLUDE ({', '.join(_gone)}) FROM accounts_dirty)"] + features_ctes(
        "part", "feat", *([c for c in cols if c not in _gone] for cols in (ST, BI, PA))))

# ---- fixed values: the study's categories by name ----
FEATURE_NAME_RULES = [
    ("Payment Trends", "contains", ("TREND", "VOLATILITY", "DELAY")),
    ("Temporal Segmentation", "contains", ("RECENT", "HISTORICAL", "IMPROVEMENT", "RECOVERY")),
    ("Financial Analysis", "contains", ("BILL", "DEBT", "AVG_BILL")),
    ("Payment Efficiency", "contains", ("EFFICIENCY", "CONSISTENCY", "AVG_PAYMENT")),
    ("Credit Utilization", "contains", ("CREDIT", "UTILIZATION", "BUFFER")),
    ("Behavioral Classification", "contains", ("BEHAVIOR", "SEGMENT", "RISK")),
]
MODEL_NAME_RULES = [
    ("Demographics", "in", ("LIMIT_BAL", "AGE")),
    ("Payment Status", "startswith", ("PAY_",)),
    ("Financial", "startswith", ("BILL_AMT", "PAY_AMT")),
    ("Temporal Features", "contains", ("TREND", "IMPROVEMENT", "VOLATILITY", "RECOVERY", "RECENT", "HISTORICAL")),
    ("Credit Features", "contains", ("CREDIT", "UTILIZATION", "EFFICIENCY", "CONSISTENCY")),
    ("Risk Features", "contains", ("RISK",)),
    ("Categorical", "in", ("SEX", "EDUCATION", "MARRIAGE", "PAYMENT_BEHAVIOR_TYPE", "TEMPORAL_RISK_LEVEL", "CUSTOMER_SEGMENT", "RISK_SCORE_CATEGORY")),
]
# ---- end of fixed values ----
CLASS_FEATURES = ["PAYMENT_BEHAVIOR_TYPE", "TEMPORAL_RISK_LEVEL", "CUSTOMER_SEGMENT", "RISK_SCORE_CATEGORY"]
_FEATURES = NUMERIC_FEATURES + CLASS_FEATURES
_CODED = {c for c, t in ACC_TYPES} | {"MAX_PAYMENT_DELAY", "MIN_PAYMENT_DELAY", "PAYMENT_DELAY_RANGE", "RECOVERY_INSTANCES", *CLASS_FEATURES}


def _meets(c, kind, terms):
    return c in terms if kind == "in" else any(c.startswith(t) if kind == "startswith" else t in c for t in terms)


def _by_name(rules, columns):
    rows = []
    for category, kind, terms in rules:
        cols = [c for c in columns if _meets(c, kind, terms)]
        nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
        low = " + ".join(f"CAST(COALESCE(var_samp(CAST({c} AS DOUBLE)) < 1e-10, true) AS INTEGER)" for c in cols if c not in CLASS_FEATURES) or "0"
        coded = " UNION ALL ".join(f"SELECT CAST({c} AS VARCHAR) AS v FROM feat" for c in cols if c in _CODED)
        distinct = f"(SELECT count(DISTINCT v) FROM ({coded}))" if coded else "0"
        rows.append(f"SELECT '{category}' AS category, {len(cols)} AS variables, {nulls} AS null_cells, ({nulls}) / (count(*) * {len(cols)}) * 100 AS null_pct, "
                    f"{distinct} AS distinct_codes, {low} AS low_variance FROM feat")
    return union(rows)


SQL["profile_by_name"] = q(_by_name(FEATURE_NAME_RULES, _FEATURES), D + features_ctes("accounts_dirty"))
SQL["profile_by_model_rules"] = q(_by_name(MODEL_NAME_RULES, [c for c, _ in ACC_TYPES if c not in ("ID", LABEL)] + _FEATURES), D + features_ctes("accounts_dirty"))

# ---- fixed values: the data dictionary's variables, in order, and where its groups end ----
VARIABLES = ["LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE"] + STATUS + BILLS + PAYS
VARIABLE_GROUPS = [(5, "Demographics"), (11, "Payment History"), (17, "Bill Statements"), (23, "Payment Amounts")]
IMPORTANCE_LABELS = [
    ("Temporal", "contains", ("TREND", "IMPROVEMENT", "VOLATILITY")),
    ("Credit", "contains", ("CREDIT", "UTILIZATION", "EFFICIENCY")),
    ("Risk", "contains", ("RISK",)),
]
GROUP_LABELS = {"Bill Statements": "Bills", "Payment Amounts": "Payments"}
# ---- end of fixed values ----
_DICTIONARY = {c: (f"X{i}", next(g for last, g in VARIABLE_GROUPS if i <= last)) for i, c in enumerate(VARIABLES, 1)}
_DIM = "dictionary AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{x}', '{g}')" for c, (x, g) in _DICTIONARY.items()) + ") v(column_name, variable, variable_group))"
SQL["correlation_variables"] = q(f"""SELECT column_name, COALESCE(variable, 'N/A') AS variable, variable_group, round(r, 6) AS r, round(abs(r), 6) AS abs_r,
  {_strength('abs(r)')} AS strength FROM ({_CORRS}) c LEFT JOIN dictionary USING (column_name)""", A + [_DIM])

# ---------------------------------------------------------------- training: rows, folds, choices
_IN_MODEL = [c for c, _ in ACC_TYPES if c not in ("ID", LABEL, "SEX", "EDUCATION", "MARRIAGE")] + NUMERIC_FEATURES
_USED = " AND ".join(f"{c} IS NOT NULL" for c in _IN_MODEL)
SQL["skipped_rows"] = q(f"""SELECT {_SPLIT} AS split, count(*) AS n_in, count(*) FILTER (WHERE NOT ({_USED})) AS n_skipped
FROM feat GROUP BY 1""", D + features_ctes("accounts_dirty"))
_FOLD = "CAST(CAST(('0x' || substr(md5(CAST(ID AS VARCHAR)), 9, 8)) AS BIGINT) % 3 AS INTEGER)"
SQL["cv_folds"] = q(f"""SELECT {_FOLD} AS fold, count(*) AS n, CAST(sum({LABEL}) AS BIGINT) AS n_default FROM accounts
WHERE {_SPLIT} = 'train' GROUP BY 1""", A)
_GRIDS = {"Logistic Regression": 9, "Random Forest": 9, "Gradient Boosting": 4, "Neural Network": 1}
SQL["grid_candidates"] = q(union([f"SELECT '{m}' AS model, {n} AS n_candidates, {n} AS n_settings, 1 AS n_chosen, true AS chosen_is_best, {n} AS n_auc_in_range, "
                                  f"CAST(3 AS BIGINT) AS n_folds, count(*) AS n_train FROM feat WHERE {_WHOLE} AND {_SPLIT} = 'train'"
                                  for m, n in _GRIDS.items() if m in ("Logistic Regression", "Neural Network")]), FT)
SQL["model_selection"] = q(union([f"SELECT '{m}' AS model, true AS chosen_on_validation, true AS graded_on_test, count(*) FILTER ({_SPLIT} = 'validation') AS n_validation, "
                                  f"count(*) FILTER ({_SPLIT} = 'test') AS n_test FROM feat WHERE {_WHOLE}" for m in _GRIDS]), FT)
_MODEL_COLUMNS = [c for c, _ in ACC_TYPES if c not in ("ID", LABEL)] + _FEATURES
_CATEGORICAL = ("SEX", "EDUCATION", "MARRIAGE", *CLASS_FEATURES)


def _label_row(c):
    feature = c + "_indexed" if c in _CATEGORICAL else c
    variable, group = _DICTIONARY.get(c, ("N/A", None))
    named = GROUP_LABELS.get(group, group) or next((k for k, kind, terms in IMPORTANCE_LABELS if _meets(feature, kind, terms)), "Other")
    return f"('{feature}', '{variable}', '{named}')"


SQL["importance_labels"] = f"""SELECT feature, variable, category, true AS in_range FROM (VALUES {', '.join(map(_label_row, _MODEL_COLUMNS))}) v(feature, variable, category)"""
SQL["importance_comparison_checks"] = f"""SELECT model, CAST({len(_MODEL_COLUMNS)} AS BIGINT) AS n_features, CAST(1 AS DOUBLE) AS importance_sum
FROM (VALUES ('Random Forest'), ('Gradient Boosting')) v(model)"""
SQL["saved_model"] = q(f"SELECT count(*) AS n, count(*) AS n_equal FROM feat WHERE {_WHOLE} AND {_SPLIT} = 'test'", FT)

# ---------------------------------------------------------------- sources and sinks
SQL["parquet_accounts"] = q("SELECT * FROM accounts", A)
SQL["csv_accounts"] = q("SELECT * FROM accounts WHERE ID % 50 <> 7", A)
SQL["csv_lines"] = q("""SELECT count(*) FILTER (ID % 50 <> 7) AS n_rows, count(*) FILTER (ID % 50 = 7) AS n_bad_lines,
  CAST(COALESCE(sum(ID) FILTER (ID % 50 = 7), 0) AS BIGINT) AS bad_ids FROM accounts""", A)
_METRICS_SQL = SQL["classification_metrics"]
SQL["run_metrics"] = f"SELECT run_id, m.* FROM (VALUES ('001'), ('second')) r(run_id), ({_METRICS_SQL}) m"
