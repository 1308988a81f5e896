"""Landed page payloads to message envelopes."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from jobloom.functions.contract import validate_contract
from jobloom.functions.json import names_object, opens_object, quotes_a_brace, read_object, with_settled

# Delivery settings of the message sink.
KAFKA_SINK = {
    "kafka.enable.idempotence": "true",
    "kafka.acks": "all",
    "kafka.compression.type": "zstd",
    "kafka.linger.ms": "50",
    "kafka.batch.num.messages": "1000",
    "kafka.client.id": "jobloom-ingestion",
    "topic": "jobs.raw",
}
# The JVM client sizes a batch in bytes, not in messages.
_BYTES_PER_MESSAGE = 4096


def unroll_pages(pages: DataFrame, max_pages: int | None = None, observe: Observation | None = None) -> DataFrame:
    """One row per posting object on the pages before the first empty one.

    A page ends the walk when its ``data`` is missing, null, empty or no array.
    The end is a scalar subquery, so the pages themselves are never shuffled.
    ``raw`` is the item's JSON text.  Items that are not objects are left out;
    ``observe`` counts them.  All landed pages count unless ``max_pages`` is given.
    """
    if max_pages is not None and max_pages < 1:
        raise ValueError("max_pages must be at least 1")
    within = pages.where(F.col("page") >= 1)
    if max_pages is not None:
        within = within.where(F.col("page") <= max_pages)
    within = with_settled(within, {"_page": read_object(F.col("payload"), {"data": "array<string>"})})
    data = F.col("_page.data")
    ending = within.where(F.coalesce(F.size(data), F.lit(0)) < 1)
    first_end = ending.agg(F.min("page")).scalar()
    # Only a page with a string that begins with a brace needs its items' JSON types.
    typed = F.when(quotes_a_brace(F.col("payload")), F.from_json("payload", "data array<variant>")["data"])
    items = within.where(first_end.isNull() | (F.col("page") < first_end)).select(
        "page", F.posexplode(data).alias("_place", "raw"), typed.alias("_typed")
    )
    kept = opens_object(F.col("raw")) & (F.col("_typed").isNull() | names_object(F.get("_typed", F.col("_place"))))
    if observe is not None:
        items = items.observe(observe, F.count(F.lit(1)).alias("items"), F.count_if(~kept).alias("bad_items"))
    return items.where(kept).select("page", "raw")


def _iso(now: datetime | Column) -> Column:
    if isinstance(now, datetime):
        return F.lit(now.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ"))
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def build_envelope(df: DataFrame, source: str, now: datetime | Column, payload: str = "raw") -> DataFrame:
    """S3: source, id, ingestion time, raw payload and typed record per posting.

    ``df`` has the JSON text ``payload`` and the ``typed`` text of the contract.
    The id is the raw slug as text, untrimmed, or '' when there is none.  ``now`` is
    given by the caller, so a rerun writes the same envelopes.
    """
    return df.select(
        F.lit(source).alias("source"),
        F.coalesce(F.get_json_object(payload, "$.slug"), F.lit("")).alias("source_id"),
        _iso(now).alias("ingested_at"),
        F.col(payload).alias("source_payload"),
        F.col("typed"),
    )


def to_messages(envelopes: DataFrame) -> DataFrame:
    """Message key and value; an empty id is keyed ``unknown``.

    Payload and typed record are JSON texts already and go into the value as they
    are; a missing typed record is an explicit null.
    """
    head = F.to_json(F.struct("source", "source_id", "ingested_at"), {"ignoreNullFields": "false"})
    value = F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1),
        F.lit(',"source_payload":'),
        F.coalesce("source_payload", F.lit("null")),
        F.lit(',"typed":'),
        F.coalesce("typed", F.lit("null")),
        F.lit("}"),
    )
    key = F.when(F.col("source_id") == "", F.lit("unknown")).otherwise(F.col("source_id"))
    return envelopes.select(key.cast("binary").alias("key"), value.cast("binary").alias("value"))


def kafka_sink_options(bootstrap_servers: str, **overrides: str) -> dict[str, str]:
    """Writer options; ``batch.num.messages`` becomes the client's byte size."""
    options = {**KAFKA_SINK, "kafka.bootstrap.servers": bootstrap_servers, **overrides}
    messages = int(options.pop("kafka.batch.num.messages"))
    options.setdefault("kafka.batch.size", str(messages * _BYTES_PER_MESSAGE))
    return options


def publish(envelopes: DataFrame, options: dict[str, str], fmt: str = "kafka") -> None:
    """S4 (action): writes the messages; delivery is at least once, W1 removes repeats."""
    to_messages(envelopes).write.format(fmt).options(**options).mode("append").save()


def rederive(bronze: DataFrame) -> DataFrame:
    """Typed records from the stored raw payloads under today's contract."""
    kept = [c for c in bronze.columns if c != "typed"]
    return validate_contract(bronze.select(*kept), payload="source_payload").select(*bronze.columns, "contract_error")
