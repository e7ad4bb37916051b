"""Fused-aggregate plumbing: compute per-column metrics for many columns in ONE
aggregate and return them in long form (one row per column) without a second
job: the wide one-row result is turned into rows by ``inline(array(struct..))``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def long_form(df: DataFrame, per_column: dict, key: str = "column_name") -> DataFrame:
    """``per_column`` maps column name -> {metric: aggregate Column}.  All inner
    dicts must have the same metric names (types are unified by ``array``)."""
    structs = [F.struct(F.lit(name).alias(key), *[c.alias(m) for m, c in metrics.items()])
               for name, metrics in per_column.items()]
    return df.agg(F.array(*structs).alias("_rows")).select(F.inline("_rows"))


def numeric_columns(df: DataFrame, exclude=()) -> list:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in ex]


def pct(num: Column, den: Column) -> Column:
    """num / den * 100, NULL (not an error) on an empty table."""
    return F.try_divide(num, den) * 100
