"""Message values to bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.json import is_object, names_object, opens_object, quotes_a_brace, read_object, with_settled
from jobloom.functions.text import iso_to_timestamp

# JSON texts that count as no typed record at all.
EMPTY_JSON = ("null", "{}", "[]", '""', "0", "0.0", "-0.0", "false")


COUNTERS = ("row_count", "bad_messages", "other_source", "unreadable_times", "payload_bytes")
MEMBERS = ("source", "source_id", "ingested_at", "source_payload", "typed")


def _json_text(member: str) -> Column:
    """JSON text of a member: objects, the rule, are at hand; the rest is read again.

    A text member may itself begin with a brace, so where the message has such a
    text anywhere the member's JSON type decides.
    """
    text = F.col(f"_read.{member}")
    again = F.from_json("_text", f"{member} variant")[member]
    is_object_text = opens_object(text) & (~F.col("_quotes") | names_object(again))
    return F.when(is_object_text, text).otherwise(F.to_json(again))


def with_value(messages: DataFrame) -> DataFrame:
    """The values that are not null, as ``value``.

    Each passes through a one-row unnest, so the filter does not compute a derived value a second time.
    """
    return messages.select(F.inline(F.array(F.struct("value")))).where(F.col("value").isNotNull())


def parse_messages(messages: DataFrame, source: str) -> DataFrame:
    """Bronze columns plus the flags ``bad`` and ``other_source``.

    A value that is no JSON object is bad; an object of another source is marked
    and otherwise ignored.  Both keep their row so that they can be counted in
    the same pass.
    """
    read = messages.select(F.col("value").cast("string").alias("_text")).withColumns(
        {"_read": read_object(F.col("_text"), dict.fromkeys(MEMBERS, "string")), "_quotes": quotes_a_brace(F.col("_text"))}
    )
    judged = read.withColumn("_bad", ~is_object("_read"))
    good = lambda column: F.when(~F.col("_bad"), column)
    record = F.when(F.col("_read.typed").isNotNull(), _json_text("typed"))
    parsed = judged.select(
        *[good(F.col(f"_read.{m}")).alias(f"_{m}") for m in ("source", "source_id", "ingested_at")],
        good(F.coalesce(_json_text("source_payload"), F.lit("{}"))).alias("_source_payload"),
        good(record).alias("_typed"),
        "_bad",
    )
    columns = {m: F.col(f"_{m}") for m in MEMBERS} | {
        "typed": F.when(~F.col("_typed").isin(*EMPTY_JSON), F.col("_typed")),
        "bad": F.col("_bad"),
        "other_source": ~F.col("_bad") & ~F.col("_source").eqNullSafe(source),
    }
    return with_settled(parsed, columns).select(*columns)


def bronze_rows(parsed: DataFrame) -> DataFrame:
    """The rows of ``parse_messages`` that belong in bronze."""
    return parsed.where(~F.col("bad") & ~F.col("other_source")).drop("bad", "other_source")


def message_counts() -> list[Column]:
    """Counters over the rows of ``parse_messages``, for ``observe``."""
    kept = ~F.col("bad") & ~F.col("other_source")
    size = F.coalesce(F.octet_length("source_payload"), F.lit(0)) + F.coalesce(F.octet_length("typed"), F.lit(0))
    return [
        F.count_if(kept).alias("row_count"),
        F.count_if("bad").alias("bad_messages"),
        F.count_if("other_source").alias("other_source"),
        F.count_if(kept & iso_to_timestamp(F.col("ingested_at")).isNull()).alias("unreadable_times"),
        F.coalesce(F.sum(F.when(kept, size.cast("bigint"))), F.lit(0).cast("bigint")).alias("payload_bytes"),
    ]
