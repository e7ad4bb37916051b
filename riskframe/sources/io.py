"""Sources and sinks."""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskframe.functions.columns import qcol
from riskframe.session import materialize

_FORMATS = ("csv", "parquet")


def load_table(spark: SparkSession, path: str, fmt: str = "csv", schema: StructType | None = None) -> DataFrame:
    """CSV (header, schema or inferred types) or Parquet scan; other formats raise.

    Pass ``schema`` for CSV at scale: inference costs a full extra scan."""
    fmt = fmt.lower()
    if fmt == "csv":
        reader = spark.read.option("header", "true")
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
        return reader.csv(path)
    if fmt == "parquet":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    raise ValueError(f"Unsupported file format: {fmt}")


#: Column that holds a CSV line which does not fit the schema.
CORRUPT = "_corrupt_record"


def load_csv(spark: SparkSession, path: str, schema: StructType, corrupt: str = CORRUPT, **options) -> tuple[DataFrame, DataFrame]:
    """A1: CSV with a stated schema, read once: (rows that fit it, lines that do not).

    Nothing is inferred and nothing is lost: a line with a value of another type, or with too
    few or too many fields, is kept as text (``corrupt``) beside what could be read of it.  The
    parsed frame is materialised, since both parts are read from it."""
    whole = StructType([*schema.fields, StructField(corrupt, StringType())])
    reader = spark.read.schema(whole).options(header="true", mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt, enforceSchema="false", **options)
    parsed = materialize(reader.csv(path))
    good = parsed.where(qcol(corrupt).isNull()).drop(corrupt)
    return good, parsed.where(qcol(corrupt).isNotNull()).select(qcol(corrupt).alias("line"))


def read_tables(spark: SparkSession, base_dir: str, names) -> dict:
    return {n: spark.read.parquet(f"{base_dir.rstrip('/')}/{n}.parquet") for n in names}


def save_table(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False,
               mode: str = "overwrite", partition_by=None) -> None:
    """Parquet or CSV sink.  ``single_file`` funnels through one task: opt-in only,
    for small outputs.  Unknown formats raise instead of silently writing nothing."""
    fmt = fmt.lower()
    if fmt not in _FORMATS:
        raise ValueError(f"Unsupported file format: {fmt}")
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.option("header", "true").csv(path)


def sample_rows(df: DataFrame, n: int, key: str | None = None, seed: int = 42) -> DataFrame:
    """Bounded sample of at most ``n`` rows (A7, chart inputs V6).

    With ``key``: exact and engine-independent -- the ``n`` rows with the
    smallest ``md5(key)``, planned as a distributed TakeOrdered (each task keeps
    its own top ``n``).  Without ``key``: Bernoulli sample at ``n / count``."""
    if key is not None:
        return df.orderBy(F.md5(qcol(key).cast("string")), qcol(key)).limit(n)
    total = df.count()
    if total <= n:
        return df
    return df.sample(withReplacement=False, fraction=n / total, seed=seed)


def save_models(models: dict, out_dir: str) -> dict:
    """Save every trained model under a file-system-safe name, overwriting."""
    paths = {}
    for name, model in models.items():
        safe = "".join(ch.lower() if ch.isalnum() else "_" for ch in name).strip("_")
        path = f"{out_dir.rstrip('/')}/{safe}"
        model.write().overwrite().save(path)
        paths[name] = path
    return paths


def save_fitted(preprocessing: PipelineModel, model: Model, path: str) -> None:
    """Preprocessing and classifier as one artefact, which another session applies to raw rows."""
    PipelineModel(stages=[*preprocessing.stages, model]).write().overwrite().save(path)


def load_fitted(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_run_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """One run's model metrics in a Parquet run table, a partition a run.  Writing a run again, as a
    retried job does, replaces its own rows and no others."""
    (metrics.withColumns({"run_id": F.lit(run_id), "run": F.lit(run_id), "recorded_at": F.current_timestamp()})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path))


def read_run_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The run table.  Run ids are those written; the folder names, whose type Spark guesses, are dropped."""
    return spark.read.parquet(path).drop("run")
