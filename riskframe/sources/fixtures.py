"""The ``accounts`` view: one row per customer in the wide 6-month panel shape,
derived from the TPC-H-like driver tables (customer, orders, lineitem).

Plan (scale notes):
  * lineitem is filtered at the scan (return flag A/R, ship year in the panel
    window -> Parquet pushed filters) and rolled up to one row per order with
    all 12 month sums in ONE aggregate;
  * the order rollup arrives hash-partitioned on the order key, so the join
    with orders re-uses that partitioning (one exchange, on orders only);
  * bills and payments are summed per customer in ONE aggregate with
    map-side partial aggregation, so a customer holding a third of all orders
    still ships one partial row per task, never its raw rows;
  * customer joins on its unique key; no broadcast of growing data.
Amounts are floored to BIGINT before summing, so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.panel import LABEL

LATEST_YEAR = 2001
MONTHS = (1, 2, 3, 4, 5, 6)
STATUS_NAMES = {1: "PAY_0", 2: "PAY_2", 3: "PAY_3", 4: "PAY_4", 5: "PAY_5", 6: "PAY_6"}


def _year_of(month: int) -> int:
    return LATEST_YEAR + 1 - month


def accounts_from_tables(customer: DataFrame, orders: DataFrame, lineitem: DataFrame,
                         with_segment: bool = False) -> DataFrame:
    first_year, last_year = _year_of(6), _year_of(1)
    li = (lineitem
          .where(F.col("l_returnflag").isin("A", "R")
                 & (F.col("l_shipdate") >= F.lit(f"{first_year}-01-01").cast("timestamp_ntz"))
                 & (F.col("l_shipdate") < F.lit(f"{last_year + 1}-01-01").cast("timestamp_ntz")))
          .select("l_orderkey", "l_returnflag",
                  F.year("l_shipdate").alias("y"),
                  F.floor(F.col("l_extendedprice") / 20).cast("bigint").alias("amt")))
    per_order = li.groupBy("l_orderkey").agg(
        *[F.sum(F.when((F.col("l_returnflag") == "A") & (F.col("y") == _year_of(m)), F.col("amt")))
          .alias(f"_paid{m}") for m in MONTHS],
        *[F.sum(F.when((F.col("l_returnflag") == "R") & (F.col("y") == _year_of(m)), 1).otherwise(0))
          .alias(f"_ret{m}") for m in MONTHS],
    )
    sign = F.when(F.col("o_orderstatus") == "P", -1).otherwise(1)
    o = orders.select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("oy"),
        (sign * F.floor(F.col("o_totalprice") / 10).cast("bigint")).alias("bill"))
    joined = o.join(per_order, o["o_orderkey"] == per_order["l_orderkey"], "left")
    per_cust = joined.groupBy("o_custkey").agg(
        *[F.sum(F.when(F.col("oy") == _year_of(m), F.col("bill"))).alias(f"_bill{m}") for m in MONTHS],
        *[F.sum(f"_paid{m}").alias(f"_paid{m}") for m in MONTHS],
        *[F.sum(f"_ret{m}").alias(f"_ret{m}") for m in MONTHS],
    )
    c = customer.select("c_custkey", "c_acctbal", "c_nationkey",
                        *(["c_mktsegment"] if with_segment else []))
    base = c.join(per_cust, c["c_custkey"] == per_cust["o_custkey"], "left")
    status = {m: F.coalesce(F.col(f"_ret{m}") - 3, F.lit(-3)) for m in MONTHS}
    key = F.col("c_custkey")
    cols = [
        key.alias("ID"),
        (F.floor(F.abs("c_acctbal")).cast("bigint") * 50 + 10000).alias("LIMIT_BAL"),
        (key % 2 + 1).cast("int").alias("SEX"),
        (F.col("c_nationkey") % 7).cast("int").alias("EDUCATION"),
        F.floor(F.col("c_nationkey") / 7).cast("int").alias("MARRIAGE"),
        (21 + key % 55).cast("int").alias("AGE"),
        *[status[m].cast("int").alias(STATUS_NAMES[m]) for m in MONTHS],
        *[F.coalesce(F.col(f"_bill{m}"), F.lit(0)).cast("bigint").alias(f"BILL_AMT{m}") for m in MONTHS],
        *[F.coalesce(F.col(f"_paid{m}"), F.lit(0)).cast("bigint").alias(f"PAY_AMT{m}") for m in MONTHS],
        F.when(status[1] + status[2] + (key * 7919) % 5 >= 2, 1).otherwise(0).cast("int").alias(LABEL),
    ]
    if with_segment:
        cols.append(F.col("c_mktsegment").alias("segment"))
    return base.select(*cols)


def accounts(spark: SparkSession, sf_dir: str, with_segment: bool = False) -> DataFrame:
    rd = lambda n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet")
    return accounts_from_tables(rd("customer"), rd("orders"), rd("lineitem"), with_segment)


def dirty(acc: DataFrame) -> DataFrame:
    """Inject nulls, duplicates, negatives and bad labels into ``accounts`` (+segment)."""
    i = F.col("ID")
    nul = lambda cond, c: F.when(cond, F.lit(None)).otherwise(F.col(c)).alias(c)
    d0 = acc.select(
        "ID", F.when(i % 120 == 31, -F.col("LIMIT_BAL")).otherwise(F.col("LIMIT_BAL")).alias("LIMIT_BAL"), "SEX",
        nul(i % 8 == 3, "EDUCATION"),
        "MARRIAGE",
        F.when(i % 83 == 17, 12).when(i % 97 == 19, 101 + i % 5).when(i % 37 != 5, F.col("AGE")).cast("int").alias("AGE"),
        "PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6",
        *[f"BILL_AMT{m}" for m in MONTHS],
        F.when(i % 91 == 7, -F.col("PAY_AMT1") - 1).otherwise(F.col("PAY_AMT1")).alias("PAY_AMT1"),
        F.when(i % 200 == 9, F.lit(-1).cast("bigint")).otherwise(F.col("PAY_AMT2")).alias("PAY_AMT2"),
        "PAY_AMT3", "PAY_AMT4", "PAY_AMT5",
        nul(i % 150 == 11, "PAY_AMT6"),
        F.when(i % 500 == 13, 2).otherwise(F.col(LABEL)).alias(LABEL),
        nul(i % 29 == 1, "segment"),
    )
    # Rows with ID % 50 == 0 appear twice: a narrow generator, so the base
    # view is computed once (a self-union would scan and shuffle it twice).
    copies = F.sequence(F.lit(1), F.when(i % 50 == 0, 2).otherwise(1))
    return d0.withColumn("_copy", F.explode(copies)).drop("_copy")


def accounts_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty(accounts(spark, sf_dir, with_segment=True))
