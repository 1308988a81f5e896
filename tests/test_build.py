from __future__ import annotations

import json
import os
from contextlib import contextmanager
from datetime import UTC, date, datetime, timedelta
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from conftest import rows
from jobloom.functions.contract import validate_contract
from jobloom.operators.diff import table_diff
from jobloom.functions.text import day_of, within_days
from jobloom.operators.gold import dim_skill, skill_demand_daily, skill_demand_of
from jobloom.operators.postings import posting_tags
from jobloom.operators.scd import scd2_changes, snapshot_input
from jobloom.plans import build as plans
from jobloom.plans import tables
from jobloom.plans.serve import top_skills
from jobloom.schemas import FCT_SKILL_DEMAND_DAILY, SILVER_POSTINGS
from jobloom.sources.bronze import read_bronze, write_bronze
from jobloom.sources.messages import parse_messages
from jobloom.sources.pages import build_envelope, to_messages, unroll_pages
from jobloom.sources.taxonomy import default_seed


def raw(slug, **values):
    return {
        "slug": slug, "company_name": "Acme", "title": "Engineer", "url": "u", "created_at": 1_704_067_200,
        "location": "Wien, Austria", "remote": True, "tags": ["py", "Spark"], "description": "60.000 EUR", **values,
    }


def ingest(spark, root, now, *postings):
    pages = spark.createDataFrame([(1, json.dumps({"data": list(postings)})), (2, '{"data":[]}')], "page int, payload string")
    envelopes = build_envelope(validate_contract(unroll_pages(pages)), "board", now)
    return write_bronze(parse_messages(to_messages(envelopes), "board"), root, now)


@pytest.mark.parametrize("buckets", [None, 2])
def test_full_build_twice(spark, tmp_path, buckets):
    names = plans.tables_below(f"twice_{buckets}_")
    run = lambda day: plans.run(spark, read_bronze(spark, root), seed, datetime(2024, 1, day), "board", buckets, names)
    assert plans.verify(spark, "board", names=names) == 2
    root = str(tmp_path / "bronze")
    seed = default_seed(spark)
    ingest(spark, root, datetime(2024, 1, 2, tzinfo=UTC), raw("a"), raw("b", remote=False), {"slug": "half"})
    assert run(2) == 0

    gold = {n: spark.table(t) for n, t in names.items()}
    assert rows(gold["fct_postings"], "posting_id", "city", "country_code") == [("a", "Vienna", "AT"), ("b", "Vienna", "AT")]
    assert rows(gold["fct_skill_demand_daily"], "skill", "posting_count", "remote_posting_count") == [("python", 2, 1), ("spark", 2, 1)]
    joined = skill_demand_daily(gold["silver_posting_tags"], gold["silver_postings"], gold["dim_skill"])
    assert rows(table_diff(joined, gold["fct_skill_demand_daily"])) == [(True, 0, 0)]
    assert rows(gold["fct_salary_mentions"], "salary_eur") == [(60000,), (60000,)]
    assert spark.table(plans.STAGING_VIEW).count() == 2
    proof = spark.createDataFrame(gold["fct_postings"].collect(), gold["fct_postings"].schema)

    # The same postings again: nothing but the time of the last sight changes.
    ingest(spark, root, datetime(2024, 1, 3, tzinfo=UTC), raw("a"), raw("b", remote=False))
    assert run(3) == 0
    now = spark.table(names["fct_postings"])
    assert rows(table_diff(proof, now, ignore=["last_seen_at"])) == [(True, 0, 0)]
    assert rows(table_diff(proof, now)) == [(True, 2, 2)]
    assert spark.table(names["snp_postings"]).count() == 2

    # A changed posting opens a second version.
    ingest(spark, root, datetime(2024, 1, 4, tzinfo=UTC), raw("a", title="Lead"))
    assert run(4) == 0
    assert rows(spark.table(names["snp_postings"]), "source_id", "title", "valid_to") == [
        ("a", "Engineer", datetime(2024, 1, 4)),
        ("a", "Lead", None),
        ("b", "Engineer", None),
    ]


def test_materialize_rejects_unknown_kinds(spark):
    with pytest.raises(ValueError):
        plans.materialize(spark.range(1), "x", kind="index")


def files(df):
    """Paths with the time of their last change."""
    return {f: os.stat(unquote(urlparse(f).path)).st_mtime_ns for f in df.inputFiles()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


DAY = datetime(2024, 1, 1)


def silver(spark, *records):
    """(id, day or None, values): silver rows."""
    rows = []
    for source_id, day, values in records:
        record = {
            "source": "s", "source_id": source_id, "title": "t", "remote": True, "tags_json": '["python"]', "country_code": "DE",
            "posting_created_at": None if day is None else DAY + timedelta(days=day, hours=5), "last_seen_at": DAY, **values,
        }
        rows.append(tuple(record.get(c) for c in SILVER_POSTINGS.fieldNames()))
    return spark.createDataFrame(rows, SILVER_POSTINGS)


@pytest.mark.parametrize("layout", [{}, {"buckets": 2, "keys": ["id"]}, {"partition_by": ["day"]}])
def test_a_table_survives_a_build_that_dies(spark, layout):
    name = f"safe.history_{len(layout)}{''.join(layout)}"
    made = lambda *ids: spark.createDataFrame([(i, f"d{i % 2}") for i in ids], "id long, day string")
    ids = lambda: [r[0] for r in rows(spark.table(name), "id")]
    plans.materialize(made(1, 2), name, **layout)
    first = tables.version_of(spark, name)
    # Dies after writing, before it is shown: readers and the next build have the rows that were there.
    lost = tables.write_version(made(9), name, **layout)
    assert ids() == [1, 2]
    now = spark.table(name)
    assert rows(plans.materialize(now.union(made(3)), name, **layout), "id") == [(1,), (2,), (3,)]
    assert not spark.catalog.tableExists(lost) and spark.catalog.tableExists(first)
    # Another shape takes the place in one call, too.
    plans.materialize(made(4).withColumn("more", F.lit(1)), name, **layout)
    assert rows(spark.table(name)) == [(4, "d0", 1)]
    assert not spark.catalog.tableExists(first)


@pytest.mark.parametrize("buckets", [None, 2])
def test_history_runs_touch_no_closed_file(spark, buckets):
    name = f"runs_{buckets}.snp"
    at = lambda day: DAY + timedelta(days=day)
    one = silver(spark, ("a", 0, {}), ("b", 0, {"title": None}), ("gone", 0, {}))
    observed = tables.observe_run(one, name, at(1), buckets)
    assert rows(observed, "source_id", "valid_from", "valid_to") == [("a", at(1), None), ("b", at(1), None), ("gone", at(1), None)]
    two = silver(spark, ("a", 0, {"title": "new"}), ("b", 0, {"title": None, "slug": "other"}), ("c", 0, {}))
    observed = tables.observe_run(two, name, at(2), buckets)
    want = [("a", "new", at(2), None), ("a", "t", at(1), at(2)), ("b", None, at(1), None), ("c", "t", at(2), None), ("gone", "t", at(1), None)]
    read = lambda: rows(spark.table(name), "source_id", "title", "valid_from", "valid_to")
    assert read() == want
    closed = lambda: files(spark.table(f"{name}_runs").where("part = 'closed'"))
    before = closed()
    assert len(before) >= 1
    tables.observe_run(two, name, at(3), buckets)
    assert read() == want and closed() == before
    with pytest.raises(ValueError, match="already"):
        tables.observe_run(two, name, at(3), buckets)
    # A run that dies before the view is replaced leaves the history as it was, and the next run clears its folders.
    with pytest.raises(RuntimeError), failing(spark, "CREATE OR REPLACE VIEW"):
        tables.observe_run(silver(spark, ("a", 0, {"title": "lost"})), name, at(4), buckets)
    assert read() == want
    tables.observe_run(silver(spark, ("a", 0, {"title": "newest"})), name, at(5), buckets)
    assert [r for r in read() if r[0] == "a"] == [("a", "new", at(2), at(5)), ("a", "newest", at(5), None), ("a", "t", at(1), at(2))]
    assert before.items() <= closed().items()
    # Only the open folder of the last run is read for the next, and at most one older one is kept.
    runs = [r.partition for r in spark.sql(f"SHOW PARTITIONS {name}_runs").collect() if "part=open" in r.partition]
    assert len(runs) == 2
    assert "PartitionFilters: [isnotnull(run" in plan(tables.open_versions(spark, name))


@contextmanager
def failing(spark, statement):
    """Spark statements that begin so raise."""
    kind, sql = type(spark), type(spark).sql

    def dying(self, text, *args, **kwargs):
        if text.startswith(statement):
            raise RuntimeError("killed")
        return sql(self, text, *args, **kwargs)

    kind.sql = dying
    try:
        yield
    finally:
        kind.sql = sql


def test_touched_days_only_are_rewritten(spark):
    name = "touched.demand"
    skills = dim_skill(default_seed(spark))
    compute = lambda s: skill_demand_of(s, skills)
    one = silver(spark, ("a", 0, {}), ("b", 1, {}), ("c", 2, {}), ("d", 3, {}), ("e", None, {}), ("f", 5, {}))
    # b moves to day 4, c loses its skill and with it its day, d is only seen again, e gets a day, f goes.
    two = silver(spark, ("a", 0, {}), ("b", 4, {}), ("c", 2, {"tags_json": "[]"}), ("d", 3, {"last_seen_at": DAY + timedelta(9)}), ("e", 0, {}), ("g", None, {}))
    tables.build_daily(compute(one), name, "posting_date")
    day = lambda n: DAY + timedelta(days=n)
    days = plans.changed_days(one, two)
    assert rows(days) == [(None,), *[(day(n),) for n in (0, 1, 2, 4, 5)]]
    before = files(spark.table(name))
    now = tables.rebuild_days(two, days, day_of(F.col("posting_created_at")), compute, name, "posting_date")
    assert rows(now) == rows(compute(two))
    kept = {f: t for f, t in before.items() if "2024-01-04" in f}
    assert len(kept) == 1 and kept.items() <= files(now).items()
    assert not before.keys() - kept.keys() & files(now).keys()
    assert now.columns == FCT_SKILL_DEMAND_DAILY.fieldNames()
    # Repeating it, also after a part of it was done, changes nothing.
    assert rows(tables.rebuild_days(two, days, day_of(F.col("posting_created_at")), compute, name, "posting_date")) == rows(compute(two))


def folders(spark, name):
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {tables.version_of(spark, name)}").collect()}


def test_very_many_days_share_folders(spark, monkeypatch):
    monkeypatch.setattr(tables, "MOST_FOLDERS", 8, raising=False)
    name, created = "spans.demand", day_of(F.col("posting_created_at"))
    skills = dim_skill(default_seed(spark))
    compute = lambda s: skill_demand_of(s, skills)
    many = [(f"p{n}", n, {}) for n in range(-3, 25)]
    one = silver(spark, *many, ("none", None, {}), ("other", 0, {"country_code": None}))
    assert rows(tables.build_daily(compute(one), name, "posting_date")) == rows(compute(one))
    assert len(folders(spark, name)) <= 9
    since = tables.read_since(spark, name, "posting_date", date(2024, 1, 15))
    assert rows(since) == rows(compute(one).where("posting_date >= '2024-01-15'")) and since.columns == FCT_SKILL_DEMAND_DAILY.fieldNames()
    assert since._jdf.queryExecution().sparkPlan().collectLeaves().head().selectedPartitions().totalNumberOfFiles() < len(folders(spark, name))
    # A posting moves, the one without a day gets one, a span loses all its rows, a new one comes.
    two = silver(spark, ("p-3", 9, {}), *[p for p in many if 0 <= p[1] < 16], ("none", 2, {}), ("new", 99, {}), ("late", None, {}))
    before = files(spark.table(name))
    days = plans.changed_days(one, two)
    now = tables.rebuild_days(two, days, created, compute, name, "posting_date")
    assert rows(now) == rows(compute(two)) and now.columns == FCT_SKILL_DEMAND_DAILY.fieldNames()
    assert len(folders(spark, name)) <= 9 and before.items() & files(now).items()
    assert rows(tables.rebuild_days(two, days, created, compute, name, "posting_date")) == rows(compute(two))
    # A table of few days that outgrows a folder for each of them.
    few, name = silver(spark, *many[:6]), "spans.grown"
    tables.build_daily(compute(few), name, "posting_date")
    assert len(folders(spark, name)) == 6
    now = tables.rebuild_days(two, plans.changed_days(few, two), created, compute, name, "posting_date")
    assert rows(now) == rows(compute(two)) and len(folders(spark, name)) <= 9


def test_days_of_a_build_that_died_are_taken_up_again(spark, tmp_path, monkeypatch):
    names = plans.tables_below("died_")
    root, seed = str(tmp_path / "bronze"), default_seed(spark)
    build = lambda day: plans.build(spark, read_bronze(spark, root), seed, datetime(2024, 1, day), None, names)
    later = 1_704_067_200 + 10 * 86_400
    ingest(spark, root, datetime(2024, 1, 2, tzinfo=UTC), raw("a"), raw("b", created_at=later))
    build(2)
    # A build sees a changed posting and dies with the daily tables done; then the posting is back to what it was.
    ingest(spark, root, datetime(2024, 1, 3, tzinfo=UTC), raw("a", remote=False))
    monkeypatch.setattr(plans, "observe_run", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        build(3)
    monkeypatch.undo()
    assert (0,) in rows(spark.table(names["fct_remote_policy_daily"]), "remote_count")
    ingest(spark, root, datetime(2024, 1, 4, tzinfo=UTC), raw("a"))
    before = files(spark.table(names["fct_remote_policy_daily"]).where(F.col("posting_date") > datetime(2024, 1, 5)))
    built = build(4)
    assert rows(built["fct_remote_policy_daily"], "remote_count") == [(1,), (1,)]
    assert len(before) == 1 and before.items() <= files(built["fct_remote_policy_daily"]).items()
    # Another taxonomy rebuilds every day.
    other = seed.select("canonical", F.lit("py").alias("aliases")).where("canonical = 'python'")
    plans.build(spark, read_bronze(spark, root), other, datetime(2024, 1, 5), None, names)
    assert rows(spark.table(names["fct_skill_demand_daily"]), "skill") == [("python",), ("python",)]


def test_a_trailing_window_reads_its_days_only(spark):
    rows_ = silver(spark, *[(f"p{n}", n, {}) for n in range(40)])
    stored = tables.build_daily(skill_demand_of(rows_, dim_skill(default_seed(spark))), "pruned.demand", "posting_date")
    window = stored.where(within_days(F.col("posting_date"), 3, date(2024, 2, 9)))
    assert len(stored.inputFiles()) == 40 and window.count() == 4
    assert "PartitionFilters: [isnotnull(posting_date" in plan(window)
    top = top_skills(stored, date(2024, 2, 9), days=3)
    assert "PartitionFilters: [isnotnull(posting_date" in plan(top) and top.count() == 4
    scan = top._jdf.queryExecution().sparkPlan().collectLeaves().head()
    assert scan.selectedPartitions().totalNumberOfFiles() == 4


def test_equal_buckets_meet_without_a_shuffle(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        current = plans.materialize(silver(spark, *[(f"p{n}", n % 9, {}) for n in range(200)]), "met.silver", buckets=4)
        tags = plans.materialize(posting_tags(current), "met.tags", buckets=4)
        facts = tags.join(current.select("source", "source_id", "country_code"), ["source", "source_id"])
        assert "SortMergeJoin" in plan(facts) and "Exchange" not in plan(facts)
        tables.observe_run(current, "met.snp", DAY, buckets=4)
        changes = scd2_changes(tables.open_versions(spark, "met.snp"), snapshot_input(current), DAY + timedelta(1))
        assert "SortMergeJoin" in plan(changes) and "Exchange" not in plan(changes)
        later = plans.materialize(current.withColumn("remote", F.col("source_id") == "p3"), "met.later", buckets=4)
        days = plans.changed_days(current, later)
        assert plan(days).count("Exchange") == 1  # of the days, below the distinct
        assert days.count() == 9
        demand = skill_demand_daily(tags, current, dim_skill(default_seed(spark)))
        assert rows(demand.agg(F.sum("posting_count"))) == [(200,)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
