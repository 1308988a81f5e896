"""Declared schemas of every table."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT, FLAG, COUNT, TIME = StringType(), BooleanType(), LongType(), TimestampNTZType()


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Identity of a posting in every layer.
POSTING_KEY = ["source", "source_id"]
# Columns whose change opens a new version; slug and the observation time do not.
VERSIONED_COLUMNS = ["title", "company_name", "remote", "location"]

PAGE = _schema(page=IntegerType(), payload=TEXT)

# The partition columns are declared so that discovery cannot turn hour=09 into a number.
BRONZE = _schema(
    source=TEXT,
    source_id=TEXT,
    ingested_at=TEXT,
    source_payload=TEXT,
    typed=TEXT,
    ingest_date=TEXT,
    hour=TEXT,
)

# Lists are read as their JSON text.
TYPED_POSTING = _schema(
    slug=TEXT,
    company_name=TEXT,
    title=TEXT,
    description=TEXT,
    remote=FLAG,
    url=TEXT,
    tags=TEXT,
    job_types=TEXT,
    location=TEXT,
    created_at=COUNT,
)

STAGING = _schema(
    source=TEXT,
    source_id=TEXT,
    ingested_at=TIME,
    slug=TEXT,
    company_name=TEXT,
    title=TEXT,
    description=TEXT,
    url=TEXT,
    location=TEXT,
    remote=FLAG,
    tags_json=TEXT,
    job_types_json=TEXT,
    created_at_epoch=COUNT,
    posting_created_at=TIME,
)

SILVER_POSTINGS = _schema(
    source=TEXT,
    source_id=TEXT,
    slug=TEXT,
    company_name=TEXT,
    title=TEXT,
    description=TEXT,
    url=TEXT,
    location=TEXT,
    remote=FLAG,
    tags_json=TEXT,
    job_types_json=TEXT,
    posting_created_at=TIME,
    last_seen_at=TIME,
    city_normalized=TEXT,
    country_code=TEXT,
)

SNAPSHOT = _schema(
    source=TEXT,
    source_id=TEXT,
    slug=TEXT,
    title=TEXT,
    company_name=TEXT,
    remote=FLAG,
    location=TEXT,
    snapshot_observed_at=TIME,
    valid_from=TIME,
    valid_to=TIME,
)

FCT_POSTINGS = _schema(
    posting_id=TEXT,
    title=TEXT,
    company_name=TEXT,
    city=TEXT,
    country_code=TEXT,
    remote=FLAG,
    url=TEXT,
    posting_created_at=TIME,
    last_seen_at=TIME,
    posting_created_date=TIME,
)

FCT_SKILL_DEMAND_DAILY = _schema(
    posting_date=TIME, skill=TEXT, country_code=TEXT, posting_count=COUNT, remote_posting_count=COUNT
)
