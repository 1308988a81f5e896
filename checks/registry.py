"""One query per operator, each over whole driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapters
from checks.adapters import table
from jobloom.functions.contract import validate_contract
from jobloom.functions.json import with_settled
from jobloom.functions.text import (
    blank_to_null,
    day_of,
    extract_salary,
    infer_country,
    normalize_city,
    parse_salary,
    posting_key,
    salary_band,
    week_of,
)
from jobloom.operators import gold, quality, scd
from jobloom.operators.dedup import latest_per_key
from jobloom.operators.diff import differing_parts, digests, located_changes, table_diff
from jobloom.operators.postings import newest_first, posting_tags, silver_postings, staging
from jobloom.plans import build as plans
from jobloom.plans import serve
from jobloom.plans.build import changed_days
from jobloom.plans.tables import build_daily, materialize, observe_run, read_since, rebuild_days
from jobloom.schemas import POSTING_KEY
from jobloom.session import shared_dir
from jobloom.sources.bronze import append_run, drop_expired, expire_partitions, read_bronze, write_bronze
from jobloom.sources.messages import bronze_rows, parse_messages
from jobloom.sources.pages import build_envelope, publish, rederive, to_messages, unroll_pages
from jobloom.sources.taxonomy import default_seed, read_seed
from jobloom.streaming.drain import drain, drain_metrics, message_stream, replay_window
from jobloom.streaming.upsert import compact_upserted, read_upserted, upsert_stream

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2024, 1, 31)
MID_MONTH = datetime(2024, 1, 15)
RUN_TS = datetime(2024, 2, 1)
WRITE_TIME = datetime(2024, 1, 31, 9, tzinfo=UTC)

# What a whole build is compared by.
BUILT_COLUMNS = {
    "silver_postings": ("source", "source_id", "title", "company_name", "remote", "location", "last_seen_at", "city_normalized", "country_code"),
    "silver_posting_tags": ("source", "source_id", "last_seen_at", "tag"),
    "snp_postings": ("source", "source_id", "title", "company_name", "remote", "location", "snapshot_observed_at", "valid_from", "valid_to"),
    "dim_skill": ("skill", "alias"),
    "dim_company": ("company_name", "posting_count", "remote_posting_count", "de_posting_count", "first_seen_at", "last_seen_at"),
    "fct_postings": ("posting_id", "title", "company_name", "city", "country_code", "remote", "url", "posting_created_at", "posting_created_date"),
    "fct_skill_demand_daily": ("posting_date", "skill", "country_code", "posting_count", "remote_posting_count"),
    "fct_remote_policy_daily": ("posting_date", "country_code", "posting_count", "remote_count"),
    "fct_salary_mentions": ("source_id", "title", "country_code", "salary_eur", "salary_band"),
}

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- inputs ----------------------------------------------------------------


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.staged(spark, events(spark, sf))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver_postings(staged(spark, sf), tiebreak=[F.col("event_id").desc()])


def skills(spark: SparkSession) -> DataFrame:
    return gold.dim_skill(default_seed(spark))


def demand(spark: SparkSession, sf: str) -> DataFrame:
    return gold.skill_demand_of(silver(spark, sf), skills(spark))


def observed(spark: SparkSession, sf: str) -> DataFrame:
    """Every observation of a posting, as the history operators read it."""
    return staged(spark, sf).select(
        *POSTING_KEY,
        "slug",
        "title",
        "company_name",
        "remote",
        "location",
        F.col("ingested_at").alias(scd.OBSERVED),
        "event_id",
    )


def history(spark: SparkSession, sf: str) -> DataFrame:
    return scd.scd2_from_history(observed(spark, sf), order=[scd.OBSERVED, "event_id"])


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events file as a stream."""
    schema = events(spark, sf).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def parsed_json(df: DataFrame, text: str | Column, schema: str) -> DataFrame:
    """Adds the members of a JSON text as ``j``, so that values are compared and not text."""
    return with_settled(df, {"j": F.from_json(text, schema)})


# --- sources, sinks, ingestion ----------------------------------------------


@query
def s1_unroll_pages(spark: SparkSession, sf: str) -> DataFrame:
    items = unroll_pages(adapters.job_pages(spark, events(spark, sf)))
    return parsed_json(items, "raw", "slug string, title string, location string, created_at bigint").select("page", "j.*")


@query
def s2_validate_contract(spark: SparkSession, sf: str) -> DataFrame:
    checked = validate_contract(adapters.raw(spark, events(spark, sf)), payload="payload")
    record = "slug string, company_name string, title string, description string, remote boolean, url string, " \
        "location string, created_at bigint, tags array<string>"
    fields = parsed_json(checked.select("event_id", "contract_error", "typed"), "typed", record)
    texts = ("slug", "company_name", "title", "description", "remote", "url", "location", "created_at")
    return fields.select(
        "event_id",
        "contract_error",
        F.col("j").isNotNull().alias("valid"),
        *[F.col(f"j.{c}").alias(f"typed_{c}") for c in texts],
        F.concat_ws(",", "j.tags").alias("typed_tags"),
    )


def board_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    landed = adapters.raw(spark, events(spark, sf)).withColumnRenamed("payload", "raw")
    return build_envelope(validate_contract(landed), "board_a", datetime(2024, 1, 31, tzinfo=UTC))


@query
def s3_envelope(spark: SparkSession, sf: str) -> DataFrame:
    read = parsed_json(board_envelopes(spark, sf), "source_payload", "company_name string, created_at bigint")
    return read.select(
        "source",
        "source_id",
        "ingested_at",
        F.col("j.company_name").alias("payload_company"),
        F.col("j.created_at").alias("payload_created_at"),
        F.col("typed").isNotNull().alias("is_typed"),
    )


@query
def s4_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Key and value of every message, read back from their bytes."""
    message = "source_id string, ingested_at string, source_payload struct<company_name: string>, typed struct<title: string>"
    read = parsed_json(to_messages(board_envelopes(spark, sf)), F.col("value").cast("string"), message)
    return read.select(
        F.col("key").cast("string").alias("message_key"),
        "j.source_id",
        "j.ingested_at",
        F.col("j.source_payload.company_name").alias("payload_company"),
        F.col("j.typed.title").alias("typed_title"),
    )


@query
def s5_drain_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Messages drained as a stream into bronze files, read back."""
    stream = adapters.messages(spark, event_stream(spark, sf)).select("value")
    root, checkpoint = shared_dir(spark, "bronze"), shared_dir(spark, "drain")
    drain(stream, "board_a", root, checkpoint, WRITE_TIME).awaitTermination()
    return bronze_summary(read_bronze(spark, root))


@query
def s10_drain_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The counters of a drain beside what it wrote."""
    stream = adapters.messages(spark, event_stream(spark, sf)).select("value")
    root = shared_dir(spark, "bronze")
    drain(stream, "board_a", root, shared_dir(spark, "drain"), WRITE_TIME).awaitTermination()
    seen = {k: v for k, v in drain_metrics(spark, root).items() if k != "payload_bytes"}
    return read_bronze(spark, root).agg(F.count(F.lit(1)).alias("written")).withColumns(
        {k: F.lit(v).cast("bigint") for k, v in seen.items()}
    )


@query
def s6_replay(spark: SparkSession, sf: str) -> DataFrame:
    """A drain and its replay under a new checkpoint: every row is in bronze twice."""
    root = shared_dir(spark, "bronze")
    for purpose in ("drain", "replay"):
        stream = adapters.messages(spark, event_stream(spark, sf)).select("value")
        drain(stream, "board_a", root, shared_dir(spark, purpose), WRITE_TIME).awaitTermination()
    return bronze_summary(read_bronze(spark, root))


@query
def s6_replay_window(spark: SparkSession, sf: str) -> DataFrame:
    """A topic drained as a whole, then three days of it replayed: the rows of those days are in bronze twice."""
    root, topic = shared_dir(spark, "bronze"), shared_dir(spark, "topic")
    sent = adapters.messages(spark, events(spark, sf)).select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"), F.col("sent_at").cast("timestamp").alias("timestamp")
    )
    sent.write.parquet(topic)
    drain(message_stream(spark, {"path": topic}, fmt="parquet"), "board_a", root, shared_dir(spark, "drain"), WRITE_TIME).awaitTermination()
    since, until = (datetime(2024, 1, day, tzinfo=UTC) for day in (10, 13))
    replay_window(spark, {"path": topic}, "board_a", root, since, until, "parquet", WRITE_TIME)
    return bronze_summary(read_bronze(spark, root))


@query
def s4_published(spark: SparkSession, sf: str) -> DataFrame:
    """Envelopes published to a file topic and drained from it."""
    root, topic = shared_dir(spark, "bronze"), shared_dir(spark, "topic")
    publish(board_envelopes(spark, sf), {"path": topic}, fmt="parquet")
    stream = message_stream(spark, {"path": topic}, fmt="parquet")
    drain(stream, "board_a", root, shared_dir(spark, "drain"), WRITE_TIME).awaitTermination()
    return bronze_summary(read_bronze(spark, root))


def bronze_summary(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("ingest_date", "hour", "source", "source_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("typed").alias("typed_count"),
        F.min(F.get_json_object("source_payload", "$.url")).alias("url"),
    )


@query
def s7_rederive(spark: SparkSession, sf: str) -> DataFrame:
    bronze = bronze_rows(parse_messages(adapters.messages(spark, events(spark, sf)), "board_a"))
    return (
        rederive(bronze)
        .groupBy("source_id", F.coalesce("contract_error", F.lit("none")).alias("contract_error"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.count("typed").alias("typed_count"))
    )


@query
def s8_parse_messages(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_messages(adapters.messages(spark, events(spark, sf)), "board_a")
    return parsed.select(
        "source",
        "source_id",
        "ingested_at",
        F.get_json_object("source_payload", "$.created_at").cast("bigint").alias("payload_created_at"),
        F.get_json_object("typed", "$.title").alias("typed_title"),
        F.col("typed").isNotNull().alias("is_typed"),
        "bad",
        "other_source",
    )


@query
def s9_bronze_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze written as a batch and read back, with the counters of the write."""
    root = shared_dir(spark, "bronze")
    written = write_bronze(parse_messages(adapters.messages(spark, events(spark, sf)), "board_a"), root, WRITE_TIME)
    return bronze_summary(read_bronze(spark, root, since=AS_OF)).withColumns(
        {
            "run_rows": F.lit(written.row_count).cast("bigint"),
            "run_bad": F.lit(written.bad_messages).cast("bigint"),
            "run_other": F.lit(written.other_source).cast("bigint"),
        }
    )


@query
def s14_retention(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per day that a 20-day retention keeps."""
    log = staged(spark, sf).withColumn("ingest_date", F.date_format("ingested_at", "yyyy-MM-dd"))
    return expire_partitions(log, AS_OF, days=20).groupBy("ingest_date").agg(F.count(F.lit(1)).alias("row_count"))


@query
def s14_dropped(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze folders of the days of the log, before and after those older than 20 days are removed."""
    root = shared_dir(spark, "bronze")
    messages = adapters.post_messages(spark, events(spark, sf))
    for board in ("board_a", "board_b"):
        kept = bronze_rows(parse_messages(messages.where(F.col("source") == board), board))
        dated = kept.withColumns({"ingest_date": F.substring("ingested_at", 1, 10), "hour": F.lit("00")})
        append_run(dated, root, board)
    per_day = read_bronze(spark, root).groupBy("ingest_date").agg(F.count(F.lit(1)).alias("row_count"))
    path = shared_dir(spark, "counts")
    per_day.write.parquet(path)
    before = spark.read.schema(per_day.schema).parquet(path)
    dropped = drop_expired(spark, root, AS_OF, days=20)
    after = read_bronze(spark, root).groupBy("ingest_date").agg(F.count(F.lit(1)).alias("row_count"))
    return before.join(after.select("ingest_date", F.col("row_count").alias("kept_count")), "ingest_date", "left").withColumn(
        "dropped", F.col("ingest_date").isin(dropped)
    )


# --- projections and scalar functions ----------------------------------------


@query
def p1_staging(spark: SparkSession, sf: str) -> DataFrame:
    """P1-P6 over parsed messages."""
    bronze = bronze_rows(parse_messages(adapters.messages(spark, events(spark, sf)), "board_a"))
    return staging(bronze).drop("tags_json", "job_types_json")


@query
def p8_fct_postings(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fct_postings(silver(spark, sf))


@query
def p9_city(spark: SparkSession, sf: str) -> DataFrame:
    log = adapters.post(spark, events(spark, sf))
    return log.select(
        "event_id",
        normalize_city(F.col("location")).alias("city"),
        blank_to_null(F.col("location")).alias("location_text"),
    )


@query
def p10_country(spark: SparkSession, sf: str) -> DataFrame:
    log = adapters.post(spark, events(spark, sf))
    return log.groupBy("location", infer_country(F.col("location")).alias("country_code")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query
def p13_posting_tags(spark: SparkSession, sf: str) -> DataFrame:
    return posting_tags(silver(spark, sf))


@query
def p13_log_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Tag occurrences over the whole log, not only current postings."""
    log = staged(spark, sf).withColumnRenamed("ingested_at", "last_seen_at")
    return posting_tags(log).groupBy("tag").agg(
        F.count(F.lit(1)).alias("occurrences"), F.max("last_seen_at").alias("last_seen_at")
    )


@query
def p17_salary_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return gold.salary_mentions(silver(spark, sf))


@query
def p17_salary_in_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Salary text functions over whole documents with a price line per document."""
    priced = table(spark, sf, "documents").withColumn(
        "text", F.concat("text", F.lit(" "), F.format_string("%d.%03d", F.col("n_chars") % 90 + 10, F.col("doc_id") % 1000), F.lit(" EUR"))
    )
    raw = extract_salary(F.col("text"))
    eur = parse_salary(raw)
    return priced.select(
        "doc_id", raw.alias("raw_salary"), eur.alias("salary_eur"), salary_band(eur).alias("salary_band")
    )


@query
def p22_week(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .groupBy(week_of(F.col("o_orderdate")).alias("week"))
        .agg(F.count(F.lit(1)).alias("order_count"))
    )


@query
def p29_posting_key(spark: SparkSession, sf: str) -> DataFrame:
    return (
        staged(spark, sf)
        .groupBy(posting_key(F.col("source"), F.col("source_id")).alias("posting_key"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


# --- deduplication ------------------------------------------------------------


@query
def w1_latest_posting(spark: SparkSession, sf: str) -> DataFrame:
    return silver(spark, sf)


UPSERTED = ["event_id", *POSTING_KEY, "title", "location", "ingested_at", "posting_created_at"]


def newest_value() -> list[Column]:
    """The order of W1 as values, the greatest of which wins."""
    return [F.col("ingested_at"), F.col("posting_created_at"), F.col("event_id")]


def upserted(spark: SparkSession, root: str, rows: DataFrame) -> None:
    upsert_stream(rows, root, shared_dir(spark, "upsert-checkpoint"), POSTING_KEY, newest_value()).awaitTermination()


@query
def w2_streaming_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The newest row per posting, kept by a stream's state."""
    rows = adapters.staged(spark, event_stream(spark, sf)).select(*UPSERTED)
    root = shared_dir(spark, "upsert")
    upserted(spark, root, rows)
    return read_upserted(spark, root, rows.schema, POSTING_KEY, newest_value())


@query
def w2_replayed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The older half of the log, then the whole log under a new checkpoint, compacted in between and at the end."""
    rows = adapters.staged(spark, event_stream(spark, sf)).select(*UPSERTED)
    root = shared_dir(spark, "upsert")
    for part in (rows.where(F.col("ingested_at") < MID_MONTH), rows):
        upserted(spark, root, part)
        compact_upserted(spark, root, rows.schema, POSTING_KEY, newest_value())
    return read_upserted(spark, root, rows.schema, POSTING_KEY, newest_value())


# --- joins and aggregations ----------------------------------------------------


@query
def a1_dim_company(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_company(silver(spark, sf))


@query
def a2_remote_policy(spark: SparkSession, sf: str) -> DataFrame:
    return gold.remote_policy_daily(silver(spark, sf))


@query
def a3_skill_demand(spark: SparkSession, sf: str) -> DataFrame:
    """The three-way join of tags, postings and skills."""
    current = silver(spark, sf)
    return gold.skill_demand_daily(posting_tags(current), current, skills(spark))


@query
def a3_skill_demand_unnested(spark: SparkSession, sf: str) -> DataFrame:
    """The same table without the large join, postings counted per source."""
    return gold.skill_demand_of(silver(spark, sf), skills(spark), by_source=True)


@query
def a4_dim_skill(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_skill(spark.sql(adapters.CATALOGUE, part=table(spark, sf, "part")))


@query
def s12_seed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A taxonomy written as a CSV file with a header and read as the seed."""
    path = shared_dir(spark, "seed")
    spark.sql(adapters.CATALOGUE, part=table(spark, sf, "part")).write.option("header", True).csv(path)
    return gold.dim_skill(read_seed(spark, path))


# --- history --------------------------------------------------------------------


@query
def c1_scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    return history(spark, sf)


@query
def c2_scd2_apply(spark: SparkSession, sf: str) -> DataFrame:
    """A history as of mid-month, then one observation of the current postings."""
    until = observed(spark, sf).where(F.col(scd.OBSERVED) < MID_MONTH)
    past = scd.scd2_from_history(until, order=[scd.OBSERVED, "event_id"]).drop("event_id")
    return scd.scd2_apply(past, scd.snapshot_input(silver(spark, sf)), RUN_TS)


@query
def c3_scd2_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return scd.scd2_as_of(history(spark, sf), MID_MONTH)


@query
def c2_history_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The stored history after runs over the postings of mid-month and of now, in equal buckets of the key."""
    name = f"{warehouse(spark)}snapshots.snp_postings"
    for day, rows in ((MID_MONTH, silver_until(spark, sf, MID_MONTH)), (RUN_TS, silver(spark, sf))):
        observe_run(rows, name, day, buckets=8)
    return spark.table(name)


# --- whole builds -----------------------------------------------------------------


def warehouse(spark: SparkSession) -> str:
    """The prefix of databases that lie in the shared folder, for one query."""
    prefix = f"q{uuid.uuid4().hex}_"
    for database in ("silver", "snapshots", "gold"):
        spark.sql(f"CREATE DATABASE {prefix}{database} LOCATION '{shared_dir(spark, database)}'")
    return prefix


def silver_until(spark: SparkSession, sf: str, until: datetime) -> DataFrame:
    log = staged(spark, sf).where(F.col("ingested_at") < F.lit(until).cast("timestamp_ntz"))
    return silver_postings(log, tiebreak=[F.col("event_id").desc()])


def rebuilt_daily(spark: SparkSession, sf: str, table_name: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A daily table of mid-month's postings, brought up to date for the days that have changed since."""
    name = f"{warehouse(spark)}gold.{table_name}"
    before, now = silver_until(spark, sf, MID_MONTH), silver(spark, sf)
    build_daily(compute(before), name, "posting_date")
    return rebuild_days(now, changed_days(before, now), day_of(F.col("posting_created_at")), compute, name, "posting_date")


@query
def a2_rebuilt_days(spark: SparkSession, sf: str) -> DataFrame:
    return rebuilt_daily(spark, sf, "fct_remote_policy_daily", gold.remote_policy_daily)


@query
def a3_rebuilt_days(spark: SparkSession, sf: str) -> DataFrame:
    return rebuilt_daily(spark, sf, "fct_skill_demand_daily", lambda rows: gold.skill_demand_of(rows, skills(spark)))


@query
def q2_stored_top_skills(spark: SparkSession, sf: str) -> DataFrame:
    """Top skills of the trailing month from the stored table, of which only that month's folders are read."""
    name = f"{warehouse(spark)}gold.fct_skill_demand_daily"
    build_daily(demand(spark, sf), name, "posting_date")
    recent = read_since(spark, name, "posting_date", AS_OF - timedelta(days=30))
    return serve.top_skills(recent, AS_OF, days=30, limit=20)


@query
def j1_bucketed_demand(spark: SparkSession, sf: str) -> DataFrame:
    """Skill demand from tags and postings stored in equal buckets, which meet without a shuffle."""
    prefix = warehouse(spark)
    current = materialize(silver(spark, sf), f"{prefix}silver.silver_postings", buckets=8)
    tags = materialize(posting_tags(current), f"{prefix}silver.silver_posting_tags", buckets=8)
    return gold.skill_demand_daily(tags, current, skills(spark))


@query
def s13_build(spark: SparkSession, sf: str) -> DataFrame:
    """Messages to every table, twice: one board until mid-month, then all; each verdict, and all rows as text."""
    prefix, root = warehouse(spark), shared_dir(spark, "bronze")
    names = plans.tables_below(prefix)
    messages = adapters.post_messages(spark, events(spark, sf))
    early = (F.col("source") == "board_a") & (F.col("ingested_at") < F.lit(MID_MONTH).cast("timestamp_ntz"))
    verdicts = []
    for run_ts, part in ((MID_MONTH, early), (RUN_TS, ~early)):
        for board in ("board_a", "board_b"):
            write_bronze(parse_messages(messages.where(part & (F.col("source") == board)), board), root, run_ts.replace(tzinfo=UTC))
        verdicts.append(plans.run(spark, read_bronze(spark, root), default_seed(spark), run_ts, "board_a", buckets=8, names=names))
    texts = [
        spark.table(names[short]).select(
            F.lit(short).alias("table_name"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]).alias("row_text"),
        )
        for short, columns in BUILT_COLUMNS.items()
    ]
    gates = spark.range(2).select(F.lit("gate").alias("table_name"), F.element_at(F.array(*map(F.lit, verdicts)), F.col("id").cast("int") + 1).cast("string").alias("row_text"))
    return reduce(DataFrame.union, [*texts, gates]).groupBy("table_name", "row_text").agg(F.count(F.lit(1)).alias("row_count"))


# --- read queries ------------------------------------------------------------------


def postings_with(spark: SparkSession, sf: str, **conditions: object) -> DataFrame:
    current = silver(spark, sf)
    return serve.list_postings(gold.fct_postings(current), posting_tags(current), skills(spark), **conditions)


@query
def q1_postings(spark: SparkSession, sf: str) -> DataFrame:
    return postings_with(spark, sf)


@query
def q1_postings_by_skill(spark: SparkSession, sf: str) -> DataFrame:
    return postings_with(spark, sf, skill="Python", limit=500)


@query
def q1_postings_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return postings_with(spark, sf, country="DE", remote=True, skill="spark", limit=20, distinct=True)


@query
def q2_top_skills(spark: SparkSession, sf: str) -> DataFrame:
    return serve.top_skills(demand(spark, sf), AS_OF, days=30, limit=20)


@query
def q2_top_skills_country(spark: SparkSession, sf: str) -> DataFrame:
    return serve.top_skills(demand(spark, sf), AS_OF, days=365, country="DE", limit=200)


@query
def q3_totals(spark: SparkSession, sf: str) -> DataFrame:
    return serve.totals(gold.fct_postings(silver(spark, sf)))


@query
def q4_top_skills_total(spark: SparkSession, sf: str) -> DataFrame:
    return serve.top_skills_total(demand(spark, sf), AS_OF)


@query
def q5_weekly_remote(spark: SparkSession, sf: str) -> DataFrame:
    return serve.weekly_remote_share(gold.remote_policy_daily(silver(spark, sf)))


@query
def q5_weekly_remote_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return serve.weekly_remote_share(gold.remote_policy_daily(silver(spark, sf)), pivot=True)


@query
def q6_skill_names(spark: SparkSession, sf: str) -> DataFrame:
    return serve.skill_names(demand(spark, sf))


@query
def q6_skill_series(spark: SparkSession, sf: str) -> DataFrame:
    return serve.skill_series(demand(spark, sf), ["python", "spark"], country="DE")


@query
def q6_skill_series_default(spark: SparkSession, sf: str) -> DataFrame:
    return serve.skill_series(demand(spark, sf))


@query
def q7_top_companies(spark: SparkSession, sf: str) -> DataFrame:
    return serve.top_companies(gold.dim_company(silver(spark, sf)))


# --- set operations and quality -------------------------------------------------------


@query
def u1_table_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Current postings against the postings as they were first seen."""
    first_seen = latest_per_key(
        staged(spark, sf), POSTING_KEY, [F.col("ingested_at").asc_nulls_last(), F.col("event_id").asc()]
    )
    before = gold.fct_postings(silver_postings(first_seen, tiebreak=[]))
    return table_diff(gold.fct_postings(silver(spark, sf)), before, ignore=["last_seen_at"])


@query
def u1_table_diff_all(spark: SparkSession, sf: str) -> DataFrame:
    """Returned lines of the order book against all others, repeats counted."""
    lines = table(spark, sf, "lineitem")
    fields = ["l_quantity", "l_discount", "l_tax", "l_linestatus"]
    returned = lines.where(F.col("l_returnflag") == "R").select(*fields)
    kept = lines.where(F.col("l_returnflag") != "R").select(*fields)
    return table_diff(returned, kept, all_rows=True)


@query
def q8_rerun_proof(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of two builds of the same postings, and of a third in which one posting has another title.

    A row per step without a difference, and per differing row else, with the number of parts that differ.
    """
    build = lambda: gold.fct_postings(silver(spark, sf))
    changed = build().withColumn("title", F.when(F.col("posting_id") == "p7", F.lit("Changed")).otherwise(F.col("title")))
    before, key = build(), ["posting_id"]
    stored = shared_dir(spark, "digests")
    digests(before, key).write.parquet(stored)
    first = spark.read.parquet(stored)
    steps = []
    for step, now in (("rerun", build()), ("changed", changed)):
        parts = differing_parts(first, digests(now, key))
        found = located_changes(before, now, parts, key).select("posting_id", "title", "company_name", "only_in_a", "only_in_b")
        counted = parts.agg(F.count(F.lit(1)).alias("parts")).withColumn("step", F.lit(step))
        steps.append(counted.join(found, F.col("parts") > 0, "left").select("step", "parts", *found.columns))
    return steps[0].union(steps[1])


@query
def u2_blend(spark: SparkSession, sf: str) -> DataFrame:
    """Two boards as one table; the second has no city and country."""
    first = silver(spark, sf).select(
        "source",
        F.col("source_id").alias("posting_id"),
        "title",
        "company_name",
        "remote",
        "posting_created_at",
        F.col("city_normalized").alias("city"),
        "country_code",
    )
    return gold.blend(first, spark.sql(adapters.ORDER_BOARD, orders=table(spark, sf, "orders")))


@query
def g_bronze_report(spark: SparkSession, sf: str) -> DataFrame:
    """The rule on the log itself, over a log in which some postings' times are unreadable."""
    parsed = parse_messages(adapters.messages(spark, events(spark, sf)), "board_a")
    spoilt = F.when(F.col("source_id").endswith("7"), F.lit("soon")).otherwise(F.col("ingested_at"))
    return quality.check(bronze_rows(parsed).withColumn("ingested_at", spoilt), quality.bronze_rules(), "bronze.")


@query
def g_spoilt_report(spark: SparkSession, sf: str) -> DataFrame:
    """Every rule over tables that break every one of them."""
    current = silver(spark, sf)
    sound = {
        "silver_postings": current,
        "silver_posting_tags": posting_tags(current),
        "fct_postings": gold.fct_postings(current),
        "dim_company": gold.dim_company(current),
        "dim_skill": gold.dim_skill(spark.sql(adapters.CATALOGUE, part=table(spark, sf, "part"))),
        "fct_skill_demand_daily": gold.skill_demand_of(current, skills(spark)),
        "fct_remote_policy_daily": gold.remote_policy_daily(current),
        "fct_salary_mentions": gold.salary_mentions(current),
    }
    spoilt = {name: spark.sql(adapters.SPOILT[name], t=df) for name, df in sound.items()}
    return quality.quality_report(spoilt, quality.table_rules("board_a"))


@query
def g_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """Every rule of every table, over tables built from the whole log."""
    current = silver(spark, sf)
    remote = gold.remote_policy_daily(current)
    tables = {
        "silver_postings": current,
        "silver_posting_tags": posting_tags(current),
        "fct_postings": gold.fct_postings(current),
        "dim_company": gold.dim_company(current),
        "dim_skill": gold.dim_skill(spark.sql(adapters.CATALOGUE, part=table(spark, sf, "part"))),
        "fct_skill_demand_daily": gold.skill_demand_of(current, skills(spark)),
        "fct_remote_policy_daily": remote,
        "fct_salary_mentions": gold.salary_mentions(current),
    }
    return quality.quality_report(tables, quality.table_rules("board_a"))
