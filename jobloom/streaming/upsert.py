"""Newest row per key, kept up to date by a stream."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from jobloom.operators.dedup import latest_per_key

# The folder of a stored row: a micro-batch's, or a compaction's.
PART = "_part"


def newest_by_state(rows: DataFrame, keys: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """The greatest row per key by ``newest`` (nulls least), as an aggregation that a stream keeps in its state.

    The state holds one row per key, so late and repeated rows never replace a newer one.  Give a tie-breaker last.
    """
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(*keys).agg(F.max_by(whole, F.struct(*newest)).alias("_row")).select("_row.*")


def _append(rows: DataFrame, root: str, part: str) -> None:
    """Action: rows as one folder; the same part again replaces it."""
    (
        rows.withColumn(PART, F.lit(part))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PART)
        .parquet(root)
    )


def upsert_stream(
    rows: DataFrame, root: str, checkpoint: str, keys: Sequence[str], newest: Sequence[Column]
) -> StreamingQuery:
    """W2 (starts a query): what a stream changes is added below ``root``, a folder per micro-batch.

    Only keys a batch touches are written.  A batch repeated after a crash replaces its own folder.  Another checkpoint
    adds its own folders: it may replay the topic or take part of it, since readers take the newest row by value.  The
    state has a row per key; keep it in RocksDB, as ``get_spark`` does, and size ``spark.sql.shuffle.partitions`` before
    the first start, because a checkpoint keeps that number.
    """
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    # An empty write creates the root, so a reader may come before the first batch.
    rows.sparkSession.createDataFrame([], _stored(rows.schema)).write.mode("append").partitionBy(PART).parquet(root)

    def add(batch: DataFrame, batch_id: int) -> None:
        _append(batch, root, f"{name}-{batch_id}")

    return (
        newest_by_state(rows, keys, newest)
        .writeStream.outputMode("update")
        .foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _stored(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add(PART, StringType())


def _parts(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    return spark.read.schema(_stored(schema)).parquet(root)


def _newest(rows: DataFrame, schema: StructType, keys: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    return latest_per_key(rows, keys, [c.desc_nulls_last() for c in newest]).select(*schema.fieldNames())


def read_upserted(
    spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], newest: Sequence[Column]
) -> DataFrame:
    """The newest row per key below ``root``."""
    return _newest(_parts(spark, root, schema), schema, keys, newest)


def compact_upserted(
    spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], newest: Sequence[Column]
) -> int:
    """Action: one folder with the newest rows in place of those that are there now; returns how many it replaced.

    The new folder is complete before an old one goes, so a crash leaves repeats, which readers ignore.  Folders that a
    running stream adds meanwhile stay.  Readers that have begun may miss the files removed: run it between reads.
    """
    seen = [r[0] for r in _parts(spark, root, schema).select(PART).distinct().collect()]
    if len(seen) < 2:
        return 0
    # The folders are named, not listed again, so what is read is what goes.
    old = _parts(spark, root, schema).where(F.col(PART).isin(seen))
    _append(_newest(old, schema, keys, newest), root, f"compacted-{uuid.uuid4().hex}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for part in seen:
        place = jvm.org.apache.hadoop.fs.Path(f"{root}/{PART}={part}")
        place.getFileSystem(conf).delete(place, True)
    return len(seen)
