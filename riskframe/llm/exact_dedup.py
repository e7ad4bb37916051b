"""Exact deduplication as a stateful streaming query.

Every row's text is normalised (white space deleted) and digested.  A streaming
aggregation keyed by digest keeps, on RocksDB state stores without watermark or
expiry, the number of rows seen and of the best row its stable identifier and
content locator (file and row index).  State lives on disk and in the query's
checkpoint in the shared folder, so a lost executor or driver resumes from the last
micro-batch.  When the stream has no more input, the state itself is read as a table
(``statestore`` source).  Digests seen more than once are hits: the full bytes of
all their texts are compared, and texts that differ under one digest are regrouped
by their bytes.  The locator names the one row that stays.

Only DataFrame functions run on the main path.

Defined results: null text counts as empty; empty texts are equal to one another; of
equal texts the one with most code points in the original stays, then the smallest
id (nulls last), then, for repeated rows, the first by locator, so exactly one row
of a group is ``kept``; the ids must be integers; extra columns are not read.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm._common import SPACE, cut, file_backed, located, only_at, pick, scratch_path, shared_rows

#: Hit digests up to which their list is broadcast to the text scan (about 100 bytes
#: each); a longer list is joined by a shuffle.
BROADCAST_DIGESTS = 200_000
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # no 4 MB of preallocated disk in each state store
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


@contextmanager
def _configured(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", "")


def sha256_digest(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def observe(rows: DataFrame) -> DataFrame:
    """The streaming aggregation over (id, n_points, digest, path, row): works on
    streaming and batch frames alike.  Greatest struct: most code points, smallest
    id, first locator."""
    best = F.struct("n_points", F.bitwise_not("id").alias("not_id"), F.bitwise_not(F.xxhash64("path")).alias("not_path"),
                    F.bitwise_not("row").alias("not_row"), "path")
    return rows.groupBy("digest").agg(F.max(best).alias("best"), F.count("*").alias("n"))


#: Bytes of the feed (some 60 a document) that a micro-batch takes; later ones meet the state of the earlier.
TRIGGER_BYTES = 256 << 20


def run_stream(spark: SparkSession, feed_path: str, schema, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Stream the feed to its end, in batches of ``TRIGGER_BYTES`` or whole files; the state as a
    frame (digest, best, n)."""
    max_bytes_per_trigger = max_bytes_per_trigger or TRIGGER_BYTES
    place = scratch_path(spark, "dedup-state")
    with _configured(spark, STATE):
        feed = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(max_bytes_per_trigger)).parquet(feed_path)
        (observe(feed).writeStream.format("noop").outputMode("update").trigger(availableNow=True)
         .option("checkpointLocation", place).start().awaitTermination())
        state = cut(spark.read.format("statestore").load(place)
                    .select(F.col("key.digest").alias("digest"), F.col("value.max").alias("best"), F.col("value.count").alias("n")))
    return state


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_digest) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, digest, _path, _row.

    ``digest`` maps the normalised text to a binary key; the result is exact for any."""
    spark = docs.sparkSession
    rows = located(file_backed(pick(docs, id_col, text_col))).select(
        F.col(id_col).cast("long").alias("id"), F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_points"),
        normalised(F.col(text_col)).alias("norm"), F.col("_path").alias("path"), F.col("_row").alias("row"))
    rows = rows.withColumn("digest", digest(F.col("norm")))
    feed_path = shared_rows(rows.drop("norm"), "dedup-feed")
    feed = spark.read.parquet(feed_path)
    state = run_stream(spark, feed_path, feed.schema)
    groups = state.select("digest", (F.bitwise_not("best.not_id")).alias("keep_id"), F.col("best.path").alias("keep_path"),
                          F.bitwise_not("best.not_row").alias("keep_row"), F.col("n").alias("group_size"))
    hits = groups.filter("group_size > 1")
    n_hits = hits.count()
    listed = hits.select("digest")
    seen = rows.join(F.broadcast(listed) if n_hits <= BROADCAST_DIGESTS else listed, "digest", "left_semi")
    # all bytes of a digest are equal if their least and greatest are; partial results shrink
    # a group of copies to one text per task before anything moves
    spread = seen.groupBy("digest").agg(F.min("norm").alias("least"), F.max("norm").alias("greatest"))
    clash = cut(spread.filter("least <> greatest").select("digest"))
    stays = (F.col("path") == F.col("keep_path")) & (F.col("row") == F.col("keep_row"))
    joined = feed.join(groups, "digest")
    parts = []
    if not clash.isEmpty():  # equal digests of different bytes: group those by the bytes
        mixed = rows.join(clash, "digest", "left_semi")
        byte_groups = mixed.groupBy("digest", "norm").agg(F.max(F.struct(
            "n_points", F.bitwise_not("id").alias("not_id"), F.bitwise_not(F.xxhash64("path")).alias("not_path"),
            F.bitwise_not("row").alias("not_row"), "path")).alias("best"), F.count("*").alias("group_size"))
        byte_groups = byte_groups.select("digest", "norm", F.bitwise_not("best.not_id").alias("keep_id"), F.col("best.path").alias("keep_path"),
                                         F.bitwise_not("best.not_row").alias("keep_row"), "group_size")
        parts.append(mixed.join(byte_groups, ["digest", "norm"]))
        joined = joined.join(clash, "digest", "left_anti")
    columns = [F.col("id").alias(id_col), F.col("keep_id"), F.col("group_size").cast("long").alias("group_size"), stays.alias("kept"),
               F.col("digest"), F.col("path").alias("_path"), F.col("row").alias("_row")]
    out = joined.select(*columns)
    for p in parts:
        out = out.unionByName(p.select(*columns))
    return out


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = file_backed(docs)
    spots = exact_groups(docs, id_col, text_col).filter("kept").select("_path", "_row")
    return only_at(docs, spots)


SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER g = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST)
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm._common import table

    return exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
