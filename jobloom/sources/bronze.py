"""Bronze files: partitioned Parquet, read back with a declared schema."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobloom.schemas import BRONZE

from .messages import bronze_rows, message_counts

# One folder per run below the write hour, so a retried run replaces its own rows only.
PARTITIONS = ["ingest_date", "hour", "run"]


@dataclass(frozen=True)
class BronzeMetrics:
    """What one write did."""

    row_count: int
    bad_messages: int
    other_source: int
    unreadable_times: int
    payload_bytes: int
    path: str

    @property
    def skipped(self) -> bool:
        return self.row_count == 0


def with_write_time(rows: DataFrame, write_time: datetime | None) -> DataFrame:
    """Partition columns from the UTC write time; the clock's when not given."""
    if write_time is None:
        now: Column = F.current_timestamp()
        day, hour = F.date_format(now, "yyyy-MM-dd"), F.date_format(now, "HH")
    else:
        utc = write_time.astimezone(UTC)
        day, hour = F.lit(f"{utc:%Y-%m-%d}"), F.lit(f"{utc:%H}")
    return rows.withColumns({"ingest_date": day, "hour": hour})


def append_run(rows: DataFrame, root: str, run: str) -> None:
    """Action: writes rows with a write time as one run; the same run again replaces it."""
    (
        rows.withColumn("run", F.lit(run))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*PARTITIONS)
        .parquet(root)
    )


def write_bronze(
    parsed: DataFrame, root: str, write_time: datetime | None = None, run: str | None = None
) -> BronzeMetrics:
    """S9, S10 (action): adds the kept rows of ``parse_messages`` below ``root``.

    The counters are observed in the writing pass itself.  No rows, no files.
    """
    seen = Observation()
    rows = bronze_rows(parsed.observe(seen, *message_counts()))
    append_run(with_write_time(rows, write_time), root, run or f"run-{uuid.uuid4().hex}")
    return BronzeMetrics(**seen.get, path=root)


def read_bronze(spark: SparkSession, root: str, since: date | None = None) -> DataFrame:
    """All bronze rows, or only the partitions written on or after ``since``."""
    bronze = spark.read.schema(BRONZE).parquet(root).select(*BRONZE.fieldNames())
    return bronze if since is None else bronze.where(F.col("ingest_date") >= since.isoformat())


def expire_partitions(df: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    """Without the partitions written more than ``days`` days before ``as_of``."""
    return df.where(F.col("ingest_date") >= (as_of - timedelta(days=days)).isoformat())


def drop_expired(spark: SparkSession, root: str, as_of: date, days: int = 90) -> list[str]:
    """S14 (action): removes the day folders that ``expire_partitions`` leaves out; returns their days.

    The driver lists day folders only; a folder that is no day stays.
    """
    oldest = (as_of - timedelta(days=days)).isoformat()
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for status in files.listStatus(top):
        key, _, day = status.getPath().getName().partition("=")
        if key == "ingest_date" and day < oldest and files.delete(status.getPath(), True):
            gone.append(day)
    return sorted(gone)
