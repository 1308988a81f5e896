"""Bounded drains of a message stream into bronze, and replays of a part of it."""

from __future__ import annotations

import hashlib
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobloom.sources.bronze import BronzeMetrics, append_run, with_write_time, write_bronze
from jobloom.sources.messages import COUNTERS, bronze_rows, message_counts, parse_messages, with_value

MESSAGE_SCHEMA = "key BINARY, value BINARY"
# Below the bronze root, where readers of bronze do not look.
METRICS = "_metrics"
_METRICS_SCHEMA = ", ".join(["run STRING", "batch BIGINT", *(f"{c} BIGINT" for c in COUNTERS)])


def message_stream(
    spark: SparkSession, options: dict[str, str], fmt: str = "kafka", max_per_batch: int = 10_000
) -> DataFrame:
    """The stream of message values, earliest first.

    ``max_per_batch`` bounds one micro-batch: messages of a Kafka topic, files of
    any other source.  Raise it with the cluster; a drain takes as many batches
    as it needs.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        limits = {"startingOffsets": "earliest", "maxOffsetsPerTrigger": str(max_per_batch)}
    else:
        reader = reader.schema(MESSAGE_SCHEMA)
        limits = {"maxFilesPerTrigger": str(max_per_batch)}
    return reader.options(**{**limits, **options}).load().select("value")


def _run_of(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def _record(counts: DataFrame, root: str) -> None:
    """Action: counters as folders by run and batch; those of a repeated batch are replaced."""
    (
        counts.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run", "batch")
        .parquet(f"{root}/{METRICS}")
    )


def drain(
    messages: DataFrame, source: str, root: str, checkpoint: str, write_time: datetime | None = None
) -> StreamingQuery:
    """S5 (starts a query): everything available now goes to bronze, then the query ends.

    The checkpoint advances after a batch is written.  Each batch is one run,
    named after the checkpoint and the batch, and takes its write time from the
    batch's own logged clock; a batch repeated after a crash replaces itself.
    S6: a new checkpoint replays from the start, as further runs.  S10: the
    counters of a batch are stored after its rows and before the checkpoint
    advances, so they outlive the driver and count a repeated batch once.
    """
    spark = messages.sparkSession
    parsed = parse_messages(with_value(messages), source)
    rows = with_write_time(parsed, write_time)
    run = _run_of(checkpoint)
    _record(spark.createDataFrame([], _METRICS_SCHEMA), root)  # a drain without messages has counters, too

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        append_run(bronze_rows(batch.observe(seen, *message_counts())), root, f"{run}-{batch_id}")
        counts = [(run, batch_id, *(seen.get[c] for c in COUNTERS))]
        _record(spark.createDataFrame(counts, _METRICS_SCHEMA), root)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """The stored counters of all drains into ``root``, a row per run and batch."""
    return spark.read.schema(_METRICS_SCHEMA).parquet(f"{root}/{METRICS}")


def drain_metrics(spark: SparkSession, root: str, checkpoint: str | None = None) -> dict[str, int]:
    """Counters summed over every batch of every drain into ``root``, or of one checkpoint's."""
    stored = read_metrics(spark, root)
    if checkpoint is not None:
        stored = stored.where(F.col("run") == _run_of(checkpoint))
    return stored.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS]).first().asDict()


def window_options(since: datetime, until: datetime) -> dict[str, str]:
    """Options of a Kafka batch read that begins and ends about the window; a partition without later messages is no error."""
    millis = lambda t: str(int(t.astimezone(UTC).timestamp() * 1000))
    return {
        "startingTimestamp": millis(since),
        "endingTimestamp": millis(until),
        "startingOffsetsByTimestampStrategy": "latest",
    }


def replay_window(
    spark: SparkSession,
    options: dict[str, str],
    source: str,
    root: str,
    since: datetime,
    until: datetime,
    fmt: str = "kafka",
    write_time: datetime | None = None,
    run: str | None = None,
) -> BronzeMetrics:
    """S6 (action): the messages of a topic from ``since`` until before ``until`` go to bronze as one more run.

    A broker is asked for the offsets of these times, a file topic is filtered; a topic's own time is not always in
    order, so the time of every message decides.  The same ``run`` again replaces it.  No checkpoint moves.
    """
    reader = spark.read.format(fmt)
    if fmt == "kafka":
        options = {**window_options(since, until), **options}
    else:
        reader = reader.schema(f"{MESSAGE_SCHEMA}, timestamp TIMESTAMP")
    at = F.col("timestamp")
    within = (at >= F.lit(since.astimezone(UTC))) & (at < F.lit(until.astimezone(UTC)))
    messages = reader.options(**options).load().where(within)
    return write_bronze(parse_messages(with_value(messages), source), root, write_time, run)
