"""Session helpers.

The library never creates machine-local scratch space on a cluster: lineage is
cut with ``checkpoint()`` into the shared folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (unit tests, a
laptop) do we fall back to a folder the caller passes in.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "riskframe", cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench: AQE on, UI off, UTC."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # per-call origin capture costs ~15 py4j round trips per Column function;
        # a wide feature plan is built from thousands of them
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # checkpoint files of collected DataFrames are removed by the cleaner
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Return the checkpoint folder, reading the cluster's own setting first.

    ``fallback`` is used only where neither the SparkContext nor the
    ``spark.checkpoint.dir`` conf names a folder (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    target = conf_dir or fallback
    if target:
        sc.setCheckpointDir(target)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, fallback_dir: str | None = None) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never ``localCheckpoint``."""
    if ensure_checkpoint_dir(df.sparkSession, fallback_dir) is None:
        raise RuntimeError("no checkpoint folder: set spark.checkpoint.dir")
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder, for a table one step hands to the next."""
    if ensure_checkpoint_dir(spark) is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("no shared folder: set spark.checkpoint.dir")
        ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="riskframe-checkpoint-"))
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, fallback_dir: str | None = None) -> DataFrame:
    """Phase hand-off for frames that several passes read (feature table before
    evaluation, correlation, training).  Reliable checkpoint into the cluster's
    checkpoint folder: lineage is cut, a lost executor re-reads the checkpoint instead
    of recomputing the shuffles, and the files go with the frame
    (``spark.cleaner.referenceTracking.cleanCheckpoints``), so there is nothing to
    release.  A plain ``local[...]`` session without a folder gets a temporary one; a
    cluster without one is an error."""
    sc = df.sparkSession.sparkContext
    if fallback_dir is None and re.fullmatch(r"local(\[.*\])?", sc.master) and not sc.getCheckpointDir():
        fallback_dir = tempfile.mkdtemp(prefix="riskframe-checkpoint-")
    return cut_lineage(df, fallback_dir)
