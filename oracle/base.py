"""Shared CTEs: the ``accounts`` fixture, its dirty variant and the feature view.

Literal rules for cross-engine equality: decimal-looking literals are DECIMAL in
DuckDB, so every fractional literal is written in exponent form (``2e-1``) to be
DOUBLE in both engines; ``/`` on integers is DOUBLE in both.
"""

ACCOUNTS_CTE = """accounts AS (
WITH b AS (SELECT o_custkey,
    COALESCE(SUM(CASE WHEN year(o_orderdate)=2001 THEN (CASE WHEN o_orderstatus='P' THEN -1 ELSE 1 END)*CAST(floor(o_totalprice/10) AS BIGINT) END),0) AS BILL_AMT1,
    COALESCE(SUM(CASE WHEN year(o_orderdate)=2000 THEN (CASE WHEN o_orderstatus='P' THEN -1 ELSE 1 END)*CAST(floor(o_totalprice/10) AS BIGINT) END),0) AS BILL_AMT2,
    COALESCE(SUM(CASE WHEN year(o_orderdate)=1999 THEN (CASE WHEN o_orderstatus='P' THEN -1 ELSE 1 END)*CAST(floor(o_totalprice/10) AS BIGINT) END),0) AS BILL_AMT3,
    COALESCE(SUM(CASE WHEN year(o_orderdate)=1998 THEN (CASE WHEN o_orderstatus='P' THEN -1 ELSE 1 END)*CAST(floor(o_totalprice/10) AS BIGINT) END),0) AS BILL_AMT4,
    COALESCE(SUM(CASE WHEN year(o_orderdate)=1997 THEN (CASE WHEN o_orderstatus='P' THEN -1 ELSE 1 END)*CAST(floor(o_totalprice/10) AS BIGINT) END),0) AS BILL_AMT5,
    COALESCE(SUM(CASE WHEN year(o_orderdate)=1996 THEN (CASE WHEN o_orderstatus='P' THEN -1 ELSE 1 END)*CAST(floor(o_totalprice/10) AS BIGINT) END),0) AS BILL_AMT6
  FROM orders GROUP BY o_custkey),
p AS (SELECT o_custkey,
    COALESCE(SUM(CASE WHEN l_returnflag='A' AND year(l_shipdate)=2001 THEN CAST(floor(l_extendedprice/20) AS BIGINT) END),0) AS PAY_AMT1,
    COALESCE(SUM(CASE WHEN l_returnflag='A' AND year(l_shipdate)=2000 THEN CAST(floor(l_extendedprice/20) AS BIGINT) END),0) AS PAY_AMT2,
    COALESCE(SUM(CASE WHEN l_returnflag='A' AND year(l_shipdate)=1999 THEN CAST(floor(l_extendedprice/20) AS BIGINT) END),0) AS PAY_AMT3,
    COALESCE(SUM(CASE WHEN l_returnflag='A' AND year(l_shipdate)=1998 THEN CAST(floor(l_extendedprice/20) AS BIGINT) END),0) AS PAY_AMT4,
    COALESCE(SUM(CASE WHEN l_returnflag='A' AND year(l_shipdate)=1997 THEN CAST(floor(l_extendedprice/20) AS BIGINT) END),0) AS PAY_AMT5,
    COALESCE(SUM(CASE WHEN l_returnflag='A' AND year(l_shipdate)=1996 THEN CAST(floor(l_extendedprice/20) AS BIGINT) END),0) AS PAY_AMT6,
    SUM(CASE WHEN l_returnflag='R' AND year(l_shipdate)=2001 THEN 1 ELSE 0 END)-3 AS PAY_0,
    SUM(CASE WHEN l_returnflag='R' AND year(l_shipdate)=2000 THEN 1 ELSE 0 END)-3 AS PAY_2,
    SUM(CASE WHEN l_returnflag='R' AND year(l_shipdate)=1999 THEN 1 ELSE 0 END)-3 AS PAY_3,
    SUM(CASE WHEN l_returnflag='R' AND year(l_shipdate)=1998 THEN 1 ELSE 0 END)-3 AS PAY_4,
    SUM(CASE WHEN l_returnflag='R' AND year(l_shipdate)=1997 THEN 1 ELSE 0 END)-3 AS PAY_5,
    SUM(CASE WHEN l_returnflag='R' AND year(l_shipdate)=1996 THEN 1 ELSE 0 END)-3 AS PAY_6
  FROM lineitem JOIN orders ON l_orderkey=o_orderkey GROUP BY o_custkey)
SELECT c_custkey AS ID,
  CAST(floor(abs(c_acctbal)) AS BIGINT)*50+10000 AS LIMIT_BAL,
  CAST(c_custkey%2+1 AS INT) AS SEX, CAST(c_nationkey%7 AS INT) AS EDUCATION,
  CAST(floor(c_nationkey/7) AS INT) AS MARRIAGE, CAST(21+c_custkey%55 AS INT) AS AGE,
  CAST(COALESCE(PAY_0,-3) AS INT) AS PAY_0, CAST(COALESCE(PAY_2,-3) AS INT) AS PAY_2, CAST(COALESCE(PAY_3,-3) AS INT) AS PAY_3, CAST(COALESCE(PAY_4,-3) AS INT) AS PAY_4, CAST(COALESCE(PAY_5,-3) AS INT) AS PAY_5, CAST(COALESCE(PAY_6,-3) AS INT) AS PAY_6,
  CAST(COALESCE(BILL_AMT1,0) AS BIGINT) AS BILL_AMT1, CAST(COALESCE(BILL_AMT2,0) AS BIGINT) AS BILL_AMT2, CAST(COALESCE(BILL_AMT3,0) AS BIGINT) AS BILL_AMT3, CAST(COALESCE(BILL_AMT4,0) AS BIGINT) AS BILL_AMT4, CAST(COALESCE(BILL_AMT5,0) AS BIGINT) AS BILL_AMT5, CAST(COALESCE(BILL_AMT6,0) AS BIGINT) AS BILL_AMT6,
  CAST(COALESCE(PAY_AMT1,0) AS BIGINT) AS PAY_AMT1, CAST(COALESCE(PAY_AMT2,0) AS BIGINT) AS PAY_AMT2, CAST(COALESCE(PAY_AMT3,0) AS BIGINT) AS PAY_AMT3, CAST(COALESCE(PAY_AMT4,0) AS BIGINT) AS PAY_AMT4, CAST(COALESCE(PAY_AMT5,0) AS BIGINT) AS PAY_AMT5, CAST(COALESCE(PAY_AMT6,0) AS BIGINT) AS PAY_AMT6,
  CAST(CASE WHEN COALESCE(PAY_0,-3)+COALESCE(PAY_2,-3)+(c_custkey*7919)%5>=2 THEN 1 ELSE 0 END AS INT) AS default_next_month
FROM customer LEFT JOIN b ON c_custkey=b.o_custkey LEFT JOIN p ON c_custkey=p.o_custkey
)"""

DIRTY_CTE = """accounts_dirty AS (
WITH d0 AS (
SELECT ID, CASE WHEN ID%120=31 THEN -LIMIT_BAL ELSE LIMIT_BAL END AS LIMIT_BAL, SEX,
  CASE WHEN ID%8=3 THEN NULL ELSE EDUCATION END AS EDUCATION,
  MARRIAGE,
  CAST(CASE WHEN ID%83=17 THEN 12 WHEN ID%97=19 THEN 101+ID%5 WHEN ID%37=5 THEN NULL ELSE AGE END AS INT) AS AGE,
  PAY_0, PAY_2, PAY_3, PAY_4, PAY_5, PAY_6,
  BILL_AMT1, BILL_AMT2, BILL_AMT3, BILL_AMT4, BILL_AMT5, BILL_AMT6,
  CASE WHEN ID%91=7 THEN -PAY_AMT1-1 ELSE PAY_AMT1 END AS PAY_AMT1,
  CASE WHEN ID%200=9 THEN -1 ELSE PAY_AMT2 END AS PAY_AMT2,
  PAY_AMT3, PAY_AMT4, PAY_AMT5,
  CASE WHEN ID%150=11 THEN NULL ELSE PAY_AMT6 END AS PAY_AMT6,
  CASE WHEN ID%500=13 THEN 2 ELSE default_next_month END AS default_next_month,
  CASE WHEN ID%29=1 THEN NULL ELSE segment END AS segment
FROM (SELECT a.*, c_mktsegment AS segment FROM accounts a JOIN customer ON ID=c_custkey) t
)
SELECT * FROM d0 UNION ALL SELECT * FROM d0 WHERE ID%50=0
)"""


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
