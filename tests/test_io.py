import os
import tempfile

import pytest

from riskframe.sources.io import load_table, sample_rows, save_table


def test_csv_roundtrip_and_formats(spark):
    d = tempfile.mkdtemp(prefix="rf-io-")
    df = spark.createDataFrame([(1, "a b", 2.5), (2, "c", None)], "ID int, `default payment next month` string, x double")
    save_table(df, f"{d}/csv", "csv", single_file=True)
    assert len([f for f in os.listdir(f"{d}/csv") if f.endswith(".csv")]) == 1
    back = load_table(spark, f"{d}/csv", "csv")
    assert back.count() == 2 and "default payment next month" in back.columns
    save_table(df, f"{d}/pq", "parquet")
    assert load_table(spark, f"{d}/pq", "parquet").count() == 2
    with pytest.raises(ValueError):
        load_table(spark, f"{d}/pq", "orc")
    with pytest.raises(ValueError):
        save_table(df, f"{d}/x", "json")


def test_sample_rows_bounded_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "ID")
    a = [r[0] for r in sample_rows(df, 50, key="ID").collect()]
    b = [r[0] for r in sample_rows(df.repartition(5), 50, key="ID").collect()]
    assert len(a) == 50 and sorted(a) == sorted(b)
    assert sample_rows(df, 5000).count() == 1000
