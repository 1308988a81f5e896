"""No silent losses: counters over all batches, crash-safe tables, replayed upserts, JSON types, plans."""

from __future__ import annotations

import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from jobloom.operators.gold import dim_skill, skill_demand_daily
from jobloom.operators.quality import bronze_rules, check
from jobloom.sources.bronze import drop_expired, expire_partitions, read_bronze, write_bronze
from jobloom.sources.messages import bronze_rows, parse_messages
from jobloom.sources.pages import unroll_pages
from jobloom.sources.taxonomy import default_seed
from jobloom.streaming.drain import drain, drain_metrics, message_stream
from jobloom.streaming.upsert import compact_upserted, read_upserted, upsert_stream


def test_counters_cover_batches_that_recent_progress_forgets(spark, tmp_path):
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i in range(5):
            texts = [(json.dumps({"source": "b", "source_id": str(i), "ingested_at": at, "source_payload": {}}),) for at in ("2024-01-01T00:00:00Z", "soon")]
            frame = spark.createDataFrame([*texts, ("no json",)], "value string").select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"))
            frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "topic"))
        stream = message_stream(spark, {"path": str(tmp_path / "topic")}, fmt="parquet", max_per_batch=1)
        drain(stream, "b", str(tmp_path / "bronze"), str(tmp_path / "checkpoint")).awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    seen = drain_metrics(spark, str(tmp_path / "bronze"))
    assert (seen["row_count"], seen["bad_messages"], seen["unreadable_times"]) == (10, 5, 5)


def test_expired_days_are_dropped_and_no_others(spark, tmp_path):
    root = str(tmp_path / "bronze")
    value = json.dumps({"source": "b", "source_id": "1", "ingested_at": "2024-01-01T00:00:00Z", "source_payload": {}})
    for day in (1, 20, 31):
        parsed = parse_messages(spark.createDataFrame([(value,)], "value string"), "b")
        write_bronze(parsed, root, datetime(2024, 1, day, tzinfo=UTC))
    plan = expire_partitions(read_bronze(spark, root), date(2024, 1, 31), 11)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert drop_expired(spark, root, date(2024, 1, 31), days=11) == ["2024-01-01"]
    kept = read_bronze(spark, root)
    assert rows(kept, "ingest_date") == rows(expire_partitions(kept, date(2024, 1, 31), 11), "ingest_date") == [("2024-01-20",), ("2024-01-31",)]


def test_unreadable_times_fail_the_bronze_rule(spark):
    bronze = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("soon",), (None,)], "ingested_at string")
    assert rows(check(bronze, bronze_rules())) == [("ingested_at.readable", 2, False)]


def test_checkpoints_replay_and_resume_beside_each_other(spark, tmp_path):
    schema = "id long, at long, v string"
    kind = spark.createDataFrame([], schema).schema

    def put(*values):
        spark.createDataFrame(list(values), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "rows"))

    def run(name):
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "rows"))
        upsert_stream(stream, root, str(tmp_path / name), ["id"], [F.col("at"), F.col("v")]).awaitTermination()

    def read():
        return rows(read_upserted(spark, root, kind, ["id"], [F.col("at"), F.col("v")]))

    root = str(tmp_path / "root")
    put((1, 1, "old"), (2, 1, "kept"), (3, None, "no time"))
    run("first")
    put((1, 2, "mid"), (3, 0, "timed"))
    run("first")
    put((1, 3, "new"))
    run("second")  # replays everything
    assert read() == [(1, 3, "new"), (2, 1, "kept"), (3, 0, "timed")]
    assert compact_upserted(spark, root, kind, ["id"], [F.col("at"), F.col("v")]) == 3
    put((2, 5, "late"), (1, 1, "older"))
    run("first")  # resumes where it stopped; an older row changes nothing
    assert read() == [(1, 3, "new"), (2, 5, "late"), (3, 0, "timed")]


def test_a_stream_without_rows_can_be_read(spark, tmp_path):
    schema = "id long, at long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "rows"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "rows"))
    upsert_stream(stream, str(tmp_path / "root"), str(tmp_path / "c"), ["id"], [F.col("at")]).awaitTermination()
    assert rows(read_upserted(spark, str(tmp_path / "root"), stream.schema, ["id"], [F.col("at")])) == []


def test_texts_that_begin_with_a_brace_are_no_objects(spark):
    page = {"data": [{"slug": "y", "note": "{in"}, "{oops", {"slug": "z"}, '{"slug":"text"}']}
    got = unroll_pages(spark.createDataFrame([(1, json.dumps(page))], "page int, payload string"))
    assert [json.loads(r.raw)["slug"] for r in got.collect()] == ["y", "z"]
    escaped = '{"data":["\\u007b\\"slug\\":1}",{"slug":"w"}]}'
    got = unroll_pages(spark.createDataFrame([(1, escaped)], "page int, payload string"))
    assert [json.loads(r.raw)["slug"] for r in got.collect()] == ["w"]
    texts = [json.dumps({"source": "b", "source_id": "1", "source_payload": p, "typed": None}) for p in ("{oops", {"a": "{in"}, {"a": 1})]
    parsed = bronze_rows(parse_messages(spark.createDataFrame([(t,) for t in texts], "value string"), "b"))
    assert sorted(json.dumps(json.loads(r.source_payload)) for r in parsed.collect()) == ['"{oops"', '{"a": "{in"}', '{"a": 1}']


def test_tags_are_not_shuffled_to_meet_the_skills(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        tags = spark.range(200_000).select(F.lit("b").alias("source"), F.col("id").cast("string").alias("source_id"), F.lit("py").alias("tag"))
        postings = tags.select("source", "source_id", F.lit(datetime(2024, 1, 1)).alias("posting_created_at"), F.lit("DE").alias("country_code"), F.lit(True).alias("remote"))
        joined = skill_demand_daily(tags, postings, dim_skill(default_seed(spark)))
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "hashpartitioning(tag" not in plan
    assert rows(joined, "skill", "posting_count") == [("python", 200_000)]
