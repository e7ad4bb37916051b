"""A hot key (one customer with a third of all orders and lines) must give the
exact rollup, and both rollups must aggregate partially before shuffling."""

import datetime as dt
import math
import random

from riskframe.sources.fixtures import accounts_from_tables


def _tables(spark):
    rnd = random.Random(7)
    customers = [(k, f"c{k}", k % 25, rnd.uniform(-999, 9999), "SEG") for k in range(1, 61)]
    orders, lines = [], []
    for o in range(1, 901):
        cust = 1 if o % 3 == 0 else rnd.randint(2, 60)  # customer 1 holds a third of the orders
        day = dt.datetime(1995 + rnd.randint(0, 6), rnd.randint(1, 12), 1)
        orders.append((o, cust, rnd.choice("FOP"), rnd.uniform(100, 50000), day, "1-URGENT"))
        for ln in range(rnd.randint(1, 5)):
            ship = dt.datetime(1995 + rnd.randint(0, 6), rnd.randint(1, 12), 2)
            lines.append((o, 1, 1, ln + 1, 1.0, rnd.uniform(10, 9000), 0.0, 0.0, rnd.choice("ANR"), "O", ship))
    c = spark.createDataFrame(customers, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                                         "c_mktsegment string")
    o = spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                                      "o_orderdate timestamp_ntz, o_orderpriority string")
    li = spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                                      "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                                      "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    return customers, orders, lines, c, o, li


def test_hot_customer_rollup_exact(spark):
    customers, orders, lines, c, o, li = _tables(spark)
    acc = {r["ID"]: r for r in accounts_from_tables(c, o, li).collect()}
    cust_of = {ok: ck for ok, ck, *_ in orders}
    # brute force for the hot customer
    bill1 = sum((-1 if st == "P" else 1) * math.floor(tp / 10) for ok, ck, st, tp, d, _ in orders
                if ck == 1 and d.year == 2001)
    paid2 = sum(math.floor(ep / 20) for ok, *_r, ep, _d, _t, fl, _s, sd in lines
                if cust_of[ok] == 1 and fl == "A" and sd.year == 2000)
    ret1 = sum(1 for ok, *_r, fl, _s, sd in lines if cust_of[ok] == 1 and fl == "R" and sd.year == 2001) - 3
    hot = acc[1]
    assert hot["BILL_AMT1"] == bill1 and hot["PAY_AMT2"] == paid2 and hot["PAY_0"] == ret1
    assert len(acc) == 60


def test_rollups_aggregate_before_shuffle(spark):
    *_x, c, o, li = _tables(spark)
    plan = accounts_from_tables(c, o, li)._jdf.queryExecution().sparkPlan().toString()
    # partial aggregation (map-side) feeds each rollup's exchange
    assert plan.count("partial_sum") >= 2
