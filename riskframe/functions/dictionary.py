"""The variable dictionary as a dimension table, and categories by column name.

The dictionary has one row per documented column (23), so it is broadcast; results
of any size take their variable ids and groups from it by a join on the column name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.panel import GROUP_LABELS, IMPORTANCE_LABELS, VARIABLE_GROUPS, VARIABLE_IDS

#: Suffix that string indexing gives a column.
INDEXED = "_indexed"


def variable_dictionary(spark: SparkSession) -> DataFrame:
    """(column_name, variable, variable_group): X1..X23 with their groups."""
    group = lambda number: next(name for last, name in VARIABLE_GROUPS if number <= last)
    rows = [(column, variable, group(int(variable[1:]))) for column, variable in VARIABLE_IDS.items()]
    return spark.createDataFrame(rows, "column_name string, variable string, variable_group string")


def with_variables(df: DataFrame, column: str = "column_name", absent: str = "N/A") -> DataFrame:
    """``df`` with the variable id and group of the column each row names; ``absent`` as id, and no
    group, where the dictionary does not hold it.  An indexed column counts as the column itself."""
    known = variable_dictionary(df.sparkSession).withColumnRenamed("column_name", "_named")
    name = F.regexp_replace(F.col(column), INDEXED + "$", "")
    out = df.join(F.broadcast(known), name == F.col("_named"), "left").drop("_named")
    return out.withColumn("variable", F.coalesce("variable", F.lit(absent)))


def meets(name: Column, kind: str, terms) -> Column:
    """Whether a column name is among the terms, starts with one or contains one."""
    if kind == "in":
        return name.isin(list(terms))
    tests = [name.startswith(t) if kind == "startswith" else name.contains(t) for t in terms]
    return reduce(lambda a, b: a | b, tests)


def first_category(name: Column, rules, otherwise: str) -> Column:
    """The first rule's category that a name meets."""
    return F.coalesce(*[F.when(meets(name, kind, terms), category) for category, kind, terms in rules], F.lit(otherwise))


def memberships(name: Column, rules) -> Column:
    """All categories that a name meets, as an array."""
    return F.array_compact(F.array(*[F.when(meets(name, kind, terms), category) for category, kind, terms in rules]))


def with_importance_label(importance: DataFrame, otherwise: str = "Other") -> DataFrame:
    """Importances with the feature's variable id and category: its group in the dictionary (bills
    and payments apart), else by its name."""
    out = with_variables(importance, "feature")
    label = reduce(lambda c, kv: F.when(F.col("variable_group") == kv[0], kv[1]).otherwise(c), GROUP_LABELS.items(), F.col("variable_group"))
    return out.withColumn("category", F.coalesce(label, first_category(F.col("feature"), IMPORTANCE_LABELS, otherwise))).drop("variable_group")
