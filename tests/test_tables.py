from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import rows
from jobloom.operators import gold
from jobloom.operators.dedup import latest_per_key, upsert_latest
from jobloom.operators.diff import table_diff
from jobloom.operators.postings import newest_first, posting_tags, silver_postings, staging
from jobloom.schemas import BRONZE, POSTING_KEY, SILVER_POSTINGS, STAGING
from jobloom.sources.taxonomy import default_seed
from jobloom.streaming import upsert

T0 = datetime(2024, 1, 1)
STAGED = "source string, source_id string, ingested_at timestamp_ntz, title string, posting_created_at timestamp_ntz"


def at(hours):
    return T0 + timedelta(hours=hours)


def table(spark, schema, *records):
    """Rows from dicts; columns that are not named are null."""
    return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in records], schema)


def posting(source_id="a", source="board", **values):
    base = {"source": source, "source_id": source_id, "title": "t", "last_seen_at": T0, "posting_created_at": T0}
    return {**base, **values}


# --- staging and silver ----------------------------------------------------------


def test_staging_types_each_column_and_drops_untyped_rows(spark):
    typed = {
        "slug": "a", "company_name": "c", "title": "t", "description": "", "remote": True, "url": "u",
        "tags": ["py", "Mü"], "job_types": [], "location": "Köln", "created_at": 1_698_000_000,
    }
    base = {"source": "board", "source_id": "a", "ingested_at": "2024-01-01T00:00:00Z"}
    bronze = table(
        spark,
        BRONZE,
        {**base, "typed": json.dumps(typed)},
        {**base, "typed": None},
        {**base, "typed": json.dumps(typed), "ingested_at": "soon"},
    )
    out = staging(bronze)
    assert out.schema.fieldNames() == STAGING.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in STAGING]
    [row] = out.collect()
    assert (row.tags_json, row.job_types_json) == ('["py","Mü"]', "[]")
    assert (row.ingested_at, row.posting_created_at) == (T0, datetime(2023, 10, 22, 18, 40))
    assert (row.remote, row.location, row.created_at_epoch) == (True, "Köln", 1_698_000_000)


def test_newest_valid_version_wins(spark):
    log = table(
        spark,
        STAGING,
        {"source": "s", "source_id": "a", "ingested_at": at(1), "title": "old", "posting_created_at": at(9)},
        {"source": "s", "source_id": "a", "ingested_at": at(2), "title": "new", "posting_created_at": None},
        {"source": "s", "source_id": "a", "ingested_at": at(2), "title": "newest", "posting_created_at": at(1)},
        {"source": "x", "source_id": "a", "ingested_at": at(0), "title": "other board", "posting_created_at": None},
    )
    silver = silver_postings(log)
    assert silver.schema.fieldNames() == SILVER_POSTINGS.fieldNames()
    assert rows(silver, "source", "title", "last_seen_at") == [("s", "newest", at(2)), ("x", "other board", at(0))]


def test_equal_times_are_settled_by_content(spark):
    tied = [{"source": "s", "source_id": "a", "ingested_at": T0, "title": t, "posting_created_at": T0} for t in "abcdef"]
    first = silver_postings(table(spark, STAGING, *tied)).collect()
    assert silver_postings(table(spark, STAGING, *tied[::-1]).repartition(3)).collect() == first


def test_group_limit_runs_before_the_shuffle(spark):
    plan = silver_postings(table(spark, STAGING))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_deduplication_is_idempotent(spark):
    log = spark.range(2000).select(
        F.lit("s").alias("source"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("source_id"),
        F.timestamp_seconds(F.col("id") * 7919 % 1000).cast("timestamp_ntz").alias("ingested_at"),
        F.col("id").cast("string").alias("title"),
        F.lit(None).cast("timestamp_ntz").alias("posting_created_at"),
    )
    order = newest_first([F.col("title").desc()])
    once = latest_per_key(log, POSTING_KEY, order)
    assert rows(latest_per_key(once, POSTING_KEY, order)) == rows(once)
    best = {}
    for r in log.collect():
        best[r.source_id] = max(best.get(r.source_id, (datetime.min, "")), (r.ingested_at, r.title))
    assert rows(once, "source_id", "ingested_at", "title") == sorted((k, *v) for k, v in best.items())


def test_tags(spark):
    silver = table(
        spark,
        SILVER_POSTINGS,
        posting("a", tags_json='["Py"," a b ",null,3,"","py"]'),
        posting("b", tags_json="[]"),
        posting("c"),
    )
    assert rows(posting_tags(silver), "source_id", "tag") == [("a", t) for t in ("", " a b ", "3", "py", "py")]


# --- upserts --------------------------------------------------------------------------


def test_upsert_keeps_the_newest_and_repeats_safely(spark):
    order = newest_first()[:2]
    current = spark.createDataFrame([("s", "a", at(1), "old", T0), ("s", "b", at(5), "kept", T0)], STAGED)
    batch = spark.createDataFrame([("s", "a", at(2), "new", T0), ("s", "b", at(4), "late", T0), ("s", "c", at(0), "c", T0)], STAGED)
    once = upsert_latest(batch, current, POSTING_KEY, order)
    assert rows(once, "source_id", "title") == [("a", "new"), ("b", "kept"), ("c", "c")]
    assert rows(upsert_latest(batch, once, POSTING_KEY, order)) == rows(once)


NEWEST = ["ingested_at", "posting_created_at", "title"]


def newest_value():
    return [F.col(c) for c in NEWEST]


def test_upsert_stream_equals_the_batch_result_through_crashes(spark, tmp_path, monkeypatch):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    append, calls = upsert._append, []

    def dies_after_writing(*args):
        append(*args)
        calls.append(args[2])
        if len(calls) == 2:
            raise RuntimeError("killed")

    log = []
    for step in range(4):
        part = [("s", str(i % 7) if i % 5 else None, at((i * 5 + step * 3) % 11), f"{step}-{i}", T0 if i % 3 else None) for i in range(20)]
        log += part
        spark.createDataFrame(part, STAGED).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(STAGED).option("maxFilesPerTrigger", 1).parquet(source)
        monkeypatch.setattr(upsert, "_append", dies_after_writing)
        run = upsert.upsert_stream(stream, root, checkpoint, POSTING_KEY, newest_value())
        if step == 1:
            with pytest.raises(StreamingQueryException):
                run.awaitTermination()
        else:
            run.awaitTermination()
    whole = spark.createDataFrame(log, STAGED)
    expected = rows(latest_per_key(whole, POSTING_KEY, newest_first([F.col("title").desc()])))
    read = lambda: rows(upsert.read_upserted(spark, root, whole.schema, POSTING_KEY, newest_value()))
    assert read() == expected
    assert len(calls) == 5 and calls[1] == calls[2]  # the killed batch came again and replaced its folder
    monkeypatch.setattr(upsert, "_append", append)
    folders = spark.read.parquet(root).select(upsert.PART).distinct().count()
    assert upsert.compact_upserted(spark, root, whole.schema, POSTING_KEY, newest_value()) == folders
    assert upsert.compact_upserted(spark, root, whole.schema, POSTING_KEY, newest_value()) == 0
    assert read() == expected
    assert spark.read.parquet(root).count() == len(expected)

# --- gold ------------------------------------------------------------------------------


def test_skill_dimension(spark):
    seed = spark.createDataFrame([("x", "A| b||a"), ("y", None)], "canonical string, aliases string")
    assert rows(gold.dim_skill(seed)) == [("x", ""), ("x", "a"), ("x", "b")]
    assert gold.dim_skill(default_seed(spark)).count() == 63


@pytest.fixture(scope="module")
def demand_input(spark):
    silver = table(
        spark,
        SILVER_POSTINGS,
        posting("a", tags_json='["py","python","sql"]', remote=True, country_code="DE"),
        posting("b", tags_json='["python"]', remote=None, country_code="DE"),
        posting("a", source="second", tags_json='["python"]', remote=False, country_code="DE"),
        posting("c", tags_json='["python","none"]', remote=True),
        posting("d", tags_json='["python"]', remote=False, posting_created_at=None),
    )
    return silver, gold.dim_skill(default_seed(spark))


def test_skill_demand_counts_distinct_postings(demand_input):
    silver, skills = demand_input
    joined = gold.skill_demand_daily(posting_tags(silver), silver, skills)
    expected = [
        (None, "python", None, 1, 0),
        (T0, "python", None, 1, 1),
        (T0, "python", "DE", 2, 1),
        (T0, "sql", "DE", 1, 1),
    ]
    assert rows(joined) == expected
    assert rows(gold.skill_demand_of(silver, skills)) == expected


def test_skill_demand_per_source(demand_input):
    silver, skills = demand_input
    for table_ in (
        gold.skill_demand_daily(posting_tags(silver), silver, skills, by_source=True),
        gold.skill_demand_of(silver, skills, by_source=True),
    ):
        assert (T0, "python", "DE", 3, 1) in rows(table_)


def test_remote_policy(spark):
    silver = table(
        spark,
        SILVER_POSTINGS,
        posting("a", remote=True, country_code="DE"),
        posting("b", remote=False, country_code="DE", posting_created_at=at(23)),
        posting("c", remote=None),
        posting("d", remote=True, country_code="XX"),
        posting("e", remote=True, posting_created_at=None),
    )
    assert rows(gold.remote_policy_daily(silver)) == [(T0, "DE", 2, 1, 0.5), (T0, "XX", 1, 0, 0.0), (T0, "XX", 1, 1, 1.0)]


def test_company_rollup(spark):
    silver = table(
        spark,
        SILVER_POSTINGS,
        posting("a", company_name="c", remote=True, country_code="DE", last_seen_at=at(3)),
        posting("b", company_name="c", remote=None, country_code="CH", posting_created_at=at(-5)),
        posting("c"),
    )
    assert rows(gold.dim_company(silver)) == [("c", 2, 1, 1, 0, 1, at(-5), at(3))]
    assert gold.dim_company(silver, ["PL"]).columns[3] == "pl_posting_count"


def test_salaries(spark):
    texts = ["Pay 65.000 EUR", "15000 EUR", "450000 EUR", "20000€ or 90000€", "none", None]
    silver = table(spark, SILVER_POSTINGS, *[posting(str(i), description=t) for i, t in enumerate(texts)])
    assert rows(gold.salary_mentions(silver)) == [
        ("0", "t", None, 65000, "60-80k"),
        ("3", "t", None, 20000, "<40k"),
    ]
    plan = gold.salary_mentions(silver)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1


def test_blend(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([(2.5, 2)], "extra double, n int")
    assert rows(gold.blend(a, b), "n", "t", "extra") == [(1, "x", None), (2, None, 2.5)]


# --- diff ----------------------------------------------------------------------------------


def test_table_diff(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "n int, t string")
    b = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (4, "y")], "n int, t string")
    assert rows(table_diff(a, a)) == [(True, 0, 0)]
    assert rows(table_diff(a, b)) == [(True, 1, 1)]
    assert rows(table_diff(a, b, all_rows=True)) == [(True, 2, 2)]
    assert rows(table_diff(a, b.limit(0))) == [(False, 3, 0)]
    assert rows(table_diff(a.limit(0), b.limit(0))) == [(True, 0, 0)]
    assert rows(table_diff(a, b, ignore=["n"])) == [(True, 0, 0)]
