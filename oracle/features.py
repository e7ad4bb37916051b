"""SQL twin of the feature chain on a six-month panel or part of one (DuckDB dialect,
also valid Spark SQL).  Exponent-form literals keep every constant DOUBLE."""

ST = ["PAY_6", "PAY_5", "PAY_4", "PAY_3", "PAY_2", "PAY_0"]
BI = ["BILL_AMT6", "BILL_AMT5", "BILL_AMT4", "BILL_AMT3", "BILL_AMT2", "BILL_AMT1"]
PA = ["PAY_AMT6", "PAY_AMT5", "PAY_AMT4", "PAY_AMT3", "PAY_AMT2", "PAY_AMT1"]


def _sum(xs):
    return "(" + " + ".join(xs) + ")"


def _mean(xs):
    return f"({_sum(xs)} / {len(xs)})"


def _pvar(xs, mean):
    return "((" + " + ".join(f"(({x} - {mean}) * ({x} - {mean}))" for x in xs) + f") / {len(xs)})"


def _ratio(p, b):
    return f"(CASE WHEN {b} > 0 THEN {p} / {b} ELSE 0e0 END)"


def _avg(xs):
    return "((" + " + ".join(xs) + f") / {len(xs)})"


def _month(c):
    return 1 if c == "PAY_0" else int(c[-1])


def _stage1(st, bi, pa):
    """Features of the panel's own columns, all lists oldest first; constants where too few are present."""
    recent, old = [[c for c in st if _month(c) in m] for m in ((1, 2, 3), (4, 5, 6))]
    recent = sorted(recent, key=_month)
    old = sorted(old, key=_month)
    bill_recent, bill_old = [sorted((c for c in bi if _month(c) in m), key=_month) for m in ((1, 2, 3), (4, 5, 6))]
    paid = {_month(c): c for c in pa}
    ratios = [_ratio(paid[_month(b)], b) for b in bi if _month(b) in paid]
    out = {}
    if len(st) >= 3:
        out |= {"PAYMENT_TREND_SLOPE": f"({st[-1]} - {st[0]}) / 6e0", "PAYMENT_STATUS_VOLATILITY": f"sqrt({_pvar(st, _mean(st))})",
                "MAX_PAYMENT_DELAY": f"greatest({', '.join(st)})", "MIN_PAYMENT_DELAY": f"least({', '.join(st)})",
                "PAYMENT_DELAY_RANGE": f"greatest({', '.join(st)}) - least({', '.join(st)})"}
    else:
        out |= {"PAYMENT_TREND_SLOPE": "0e0", "PAYMENT_STATUS_VOLATILITY": "0e0", "MAX_PAYMENT_DELAY": "0", "MIN_PAYMENT_DELAY": "0", "PAYMENT_DELAY_RANGE": "0"}
    if recent and old:
        out |= {"RECENT_AVG_DELAY": _mean(recent), "HISTORICAL_AVG_DELAY": _mean(old), "PAYMENT_IMPROVEMENT_SCORE": f"{_mean(old)} - {_mean(recent)}"}
    else:
        out |= {"RECENT_AVG_DELAY": "0e0", "HISTORICAL_AVG_DELAY": "0e0", "PAYMENT_IMPROVEMENT_SCORE": "0e0"}
    out["RECOVERY_INSTANCES"] = "(" + " + ".join(f"(CASE WHEN {a} > {b} THEN 1 ELSE 0 END)" for a, b in zip(st, st[1:])) + ")" if len(st) >= 2 else "0"
    if len(bi) >= 3:
        debt = "0e0"
        if bill_recent and bill_old:
            debt = f"CASE WHEN {_mean(bi)} > 0 THEN ({_mean(bill_recent)} - {_mean(bill_old)}) / NULLIF({_mean(bill_old)} + 1, 0) ELSE 0e0 END"
        out |= {"BILL_TREND_SLOPE": f"({bi[-1]} - {bi[0]}) / 6e0", "BILL_AMOUNT_VOLATILITY": f"sqrt({_pvar(bi, _mean(bi))})", "AVG_BILL_AMOUNT": _mean(bi),
                "DEBT_ACCUMULATION_RATE": debt}
    else:
        out |= {"BILL_TREND_SLOPE": "0e0", "BILL_AMOUNT_VOLATILITY": "0e0", "AVG_BILL_AMOUNT": "0e0", "DEBT_ACCUMULATION_RATE": "0e0"}
    out |= {"AVG_PAYMENT_AMOUNT": "0e0", "AVG_PAYMENT_EFFICIENCY": "0e0", "PAYMENT_EFFICIENCY_TREND": "0e0", "PAYMENT_CONSISTENCY_SCORE": "0e0"}
    if pa and bi:
        out["AVG_PAYMENT_AMOUNT"] = _mean(pa)
        if ratios:
            deviation = f"sqrt({_pvar(pa, _mean(pa))})"
            first, last = (ratios[:3], ratios[-3:]) if len(ratios) >= 3 else (ratios[:len(ratios) // 2], ratios[len(ratios) // 2:])
            out |= {"AVG_PAYMENT_EFFICIENCY": _avg(ratios), "PAYMENT_EFFICIENCY_TREND": f"{_avg(first)} - {_avg(last)}" if first else "0e0",
                    "PAYMENT_CONSISTENCY_SCORE": f"CASE WHEN {deviation} > 0 THEN 1e0 / (1e0 + {deviation}) ELSE 1e0 END"}
    return "SELECT *, " + ", ".join(f"{e} AS {c}" for c, e in out.items()) + " FROM {src}"


def _stage2(bi):
    trend = "0e0"
    if len(bi) >= 3:
        trend = f"CASE WHEN LIMIT_BAL > 0 THEN {_mean(bi[:3])} / LIMIT_BAL - {_mean(bi[-3:])} / LIMIT_BAL ELSE 0e0 END"
    return f"""SELECT *, CASE WHEN LIMIT_BAL > 0 THEN AVG_BILL_AMOUNT / LIMIT_BAL ELSE 0e0 END AS CREDIT_UTILIZATION_RATIO,
  LIMIT_BAL - AVG_BILL_AMOUNT AS CREDIT_BUFFER, {trend} AS CREDIT_UTILIZATION_TREND
FROM f1"""


STAGE3 = """SELECT *,
  CASE WHEN RECENT_AVG_DELAY <= 0 AND PAYMENT_STATUS_VOLATILITY <= 1 THEN 'Excellent Payer'
       WHEN RECENT_AVG_DELAY <= 1 AND PAYMENT_STATUS_VOLATILITY <= 2 THEN 'Good Payer'
       WHEN RECENT_AVG_DELAY <= 2 AND PAYMENT_STATUS_VOLATILITY <= 3 THEN 'Fair Payer'
       WHEN PAYMENT_STATUS_VOLATILITY > 3 THEN 'Erratic Payer'
       WHEN RECENT_AVG_DELAY > 2 THEN 'Poor Payer' ELSE 'Unclassified' END AS PAYMENT_BEHAVIOR_TYPE,
  CASE WHEN PAYMENT_IMPROVEMENT_SCORE > 1 AND CREDIT_UTILIZATION_RATIO < 3e-1 THEN 'Very Low'
       WHEN PAYMENT_IMPROVEMENT_SCORE > 0 AND CREDIT_UTILIZATION_RATIO < 5e-1 THEN 'Low'
       WHEN PAYMENT_IMPROVEMENT_SCORE > -1 AND CREDIT_UTILIZATION_RATIO < 8e-1 THEN 'Medium'
       WHEN PAYMENT_IMPROVEMENT_SCORE > -2 OR CREDIT_UTILIZATION_RATIO < 9e-1 THEN 'High'
       ELSE 'Very High' END AS TEMPORAL_RISK_LEVEL,
  CASE WHEN AGE < 30 AND CREDIT_UTILIZATION_RATIO < 3e-1 THEN 'Young Conservative'
       WHEN AGE < 30 AND CREDIT_UTILIZATION_RATIO >= 3e-1 THEN 'Young Active'
       WHEN AGE >= 30 AND AGE < 50 AND CREDIT_UTILIZATION_RATIO < 5e-1 THEN 'Prime Conservative'
       WHEN AGE >= 30 AND AGE < 50 AND CREDIT_UTILIZATION_RATIO >= 5e-1 THEN 'Prime Active'
       WHEN AGE >= 50 AND CREDIT_UTILIZATION_RATIO < 4e-1 THEN 'Mature Conservative'
       WHEN AGE >= 50 AND CREDIT_UTILIZATION_RATIO >= 4e-1 THEN 'Mature Active'
       ELSE 'Unclassified' END AS CUSTOMER_SEGMENT,
  ((CASE WHEN RECENT_AVG_DELAY <= 0 THEN 0e0 WHEN RECENT_AVG_DELAY <= 1 THEN 2e-1 WHEN RECENT_AVG_DELAY <= 2 THEN 4e-1
         WHEN RECENT_AVG_DELAY <= 3 THEN 6e-1 WHEN RECENT_AVG_DELAY <= 4 THEN 8e-1 ELSE 1e0 END)
 + (CASE WHEN CREDIT_UTILIZATION_RATIO <= 3e-1 THEN 0e0 WHEN CREDIT_UTILIZATION_RATIO <= 5e-1 THEN 2e-1
         WHEN CREDIT_UTILIZATION_RATIO <= 7e-1 THEN 4e-1 WHEN CREDIT_UTILIZATION_RATIO <= 9e-1 THEN 6e-1
         WHEN CREDIT_UTILIZATION_RATIO <= 1e0 THEN 8e-1 ELSE 1e0 END)
 + (CASE WHEN AVG_PAYMENT_EFFICIENCY >= 8e-1 THEN 0e0 WHEN AVG_PAYMENT_EFFICIENCY >= 6e-1 THEN 2e-1
         WHEN AVG_PAYMENT_EFFICIENCY >= 4e-1 THEN 4e-1 WHEN AVG_PAYMENT_EFFICIENCY >= 2e-1 THEN 6e-1
         WHEN AVG_PAYMENT_EFFICIENCY >= 1e-1 THEN 8e-1 ELSE 1e0 END)
 + (CASE WHEN PAYMENT_IMPROVEMENT_SCORE > 1 THEN 0e0 WHEN PAYMENT_IMPROVEMENT_SCORE > 0 THEN 2e-1
         WHEN PAYMENT_IMPROVEMENT_SCORE > -1 THEN 4e-1 WHEN PAYMENT_IMPROVEMENT_SCORE > -2 THEN 6e-1
         WHEN PAYMENT_IMPROVEMENT_SCORE > -3 THEN 8e-1 ELSE 1e0 END)) / 4 AS TEMPORAL_RISK_SCORE
FROM f2"""

STAGE4 = """SELECT *,
  CASE WHEN TEMPORAL_RISK_SCORE <= 2e-1 THEN 'Very Low' WHEN TEMPORAL_RISK_SCORE <= 4e-1 THEN 'Low'
       WHEN TEMPORAL_RISK_SCORE <= 6e-1 THEN 'Medium' WHEN TEMPORAL_RISK_SCORE <= 8e-1 THEN 'High'
       ELSE 'Very High' END AS RISK_SCORE_CATEGORY
FROM f3"""


def features_ctes(src: str = "accounts", name: str = "feat", st=ST, bi=BI, pa=PA) -> list:
    """CTE list building ``name`` = src + 25 features of the panel columns given."""
    return [f"f1 AS ({_stage1(st, bi, pa).format(src=src)})", f"f2 AS ({_stage2(bi)})", f"f3 AS ({STAGE3})",
            f"{name} AS ({STAGE4})"]
