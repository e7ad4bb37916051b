"""Helpers shared by the operators: tables, shared scratch space, code shipping."""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space and the controls TAB..CR.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only an unset value on a plain ``local[...]`` master (tests, a laptop) gets a
    temporary folder; a cluster without the setting is an error, since a
    machine-local folder would be invisible to the other executors."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("no shared folder: set spark.checkpoint.dir")
        folder = tempfile.mkdtemp(prefix="riskframe-llm-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives lost executors, and its
    files go when the frame is garbage-collected (``cleanCheckpoints``)."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per context).

    Spark's own file distribution is used, so the executors need no copy of the
    repository."""
    sc = spark.sparkContext
    if getattr(sc, "_riskframe_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="riskframe-ship-"), "riskframe_llm.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.join("riskframe", os.path.relpath(path, package)))
    sc.addPyFile(target)
    sc._riskframe_shipped = True


def crc_mod(doc_id, m: int):
    """crc32 of the id as text, modulo ``m`` (the contracts' fold rule); a null id
    counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(m)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: extra columns, whatever their names, never clash."""
    return df.select(*[df[n] for n in names])


def hex_sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def file_backed(df: DataFrame) -> DataFrame:
    """``df`` itself if it is a plain scan of files, else written to the shared folder and
    read again, so that its rows have places that hold as long as the files do."""
    from pyspark.errors import AnalysisException

    try:
        df.select("_metadata.row_index").schema
        return df
    except AnalysisException:
        path = scratch_path(df.sparkSession, "located")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)


def located(df: DataFrame) -> DataFrame:
    """A file-backed ``df`` with ``_path`` and ``_row``: where each row's content lies."""
    return df.select(*[df[c] for c in df.columns], F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))


def only_at(df: DataFrame, spots: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of a file-backed ``df`` that lie at ``spots`` (_path, _row), or with ``left_anti`` those
    that do not; columns of ``df`` may have any names, also those of the locators."""
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return located(numbered).join(spots, ["_path", "_row"], how).select(*numbered.columns).toDF(*df.columns)


def shared_rows(df: DataFrame, name: str) -> str:
    """Write ``df`` to a new table in the shared folder; its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def hold(df: DataFrame, name: str, value) -> DataFrame:
    """``df`` with column ``name``, evaluated once per row.  The optimiser copies a plain
    column's expression into the filters and lambdas that use it, where it would be
    evaluated per use or per array element; what a generator returns it leaves alone."""
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode(F.array(value)).alias(name))
