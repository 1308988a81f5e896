"""Staging and silver tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.json import with_settled
from jobloom.functions.text import (
    epoch_to_timestamp,
    infer_country,
    iso_to_timestamp,
    normalize_city,
    normalize_tag,
)
from jobloom.schemas import POSTING_KEY, SILVER_POSTINGS, STAGING, TYPED_POSTING

from .dedup import latest_per_key


def staging(bronze: DataFrame) -> DataFrame:
    """Typed columns of every valid message; each JSON text is parsed once.

    A row whose ingestion time is malformed cannot be ordered and is left out;
    ``message_counts`` counts it on arrival and ``quality.bronze_rules`` in the gate.
    """
    timed = bronze.where(F.col("typed").isNotNull()).withColumn("_at", iso_to_timestamp(F.col("ingested_at")))
    parsed = with_settled(timed.where(F.col("_at").isNotNull()), {"_typed": F.from_json("typed", TYPED_POSTING)})
    typed = F.col("_typed")
    texts = ("slug", "company_name", "title", "description", "url", "location")
    return parsed.select(
        *POSTING_KEY,
        F.col("_at").alias("ingested_at"),
        *[typed[c].alias(c) for c in texts],
        typed["remote"].alias("remote"),
        typed["tags"].alias("tags_json"),
        typed["job_types"].alias("job_types_json"),
        typed["created_at"].alias("created_at_epoch"),
        epoch_to_timestamp(typed["created_at"]).alias("posting_created_at"),
    )


def newest_first(tiebreak: Sequence[Column] | None = None) -> list[Column]:
    """Order of W1: newest ingestion, then newest posting, then a stable tie-breaker."""
    if tiebreak is None:
        # The hash skips nulls, so which columns are null is hashed along.
        nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in STAGING.fieldNames()])
        tiebreak = [F.xxhash64(*STAGING.fieldNames(), nulls).desc()]
    return [F.col("ingested_at").desc_nulls_last(), F.col("posting_created_at").desc_nulls_last(), *tiebreak]


def silver_postings(staged: DataFrame, tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """One row per posting, the newest valid one, with city and country."""
    newest = latest_per_key(staged, POSTING_KEY, newest_first(tiebreak))
    return newest.withColumnRenamed("ingested_at", "last_seen_at").withColumns(
        {
            "city_normalized": normalize_city(F.col("location")),
            "country_code": infer_country(F.col("location")),
        }
    ).select(*SILVER_POSTINGS.fieldNames())


def tag_list(tags_json: Column) -> Column:
    """The normalised tags of one JSON array text; null items are dropped."""
    items = F.from_json(tags_json, "array<string>")
    return F.transform(F.filter(items, lambda t: t.isNotNull()), normalize_tag)


def posting_tags(silver: DataFrame) -> DataFrame:
    """One row per posting and tag occurrence; repeated and empty tags stay."""
    return silver.where(F.col("tags_json") != "[]").select(
        *POSTING_KEY, "last_seen_at", F.explode(tag_list(F.col("tags_json"))).alias("tag")
    )
