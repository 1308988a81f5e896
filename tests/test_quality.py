from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import __spark_entry__ as driver
from conftest import rows
from jobloom.operators import quality as q
from jobloom.schemas import BRONZE, FCT_POSTINGS, FCT_SKILL_DEMAND_DAILY

T0 = datetime(2024, 1, 1)


def report(df, *rules):
    return {r.rule: r.failed_rows for r in q.check(df, rules).collect()}


def test_row_rules(spark):
    df = spark.createDataFrame([("DE", 1, 0), ("FR", 0, 2), (None, None, 1), ("XX", 7, 7)], "c string, n int, m int")
    assert report(
        df, *q.not_null("c", "n", "m"), q.accepted("c", ["DE"]), q.in_range("n", lo=1), q.in_range("n", 1, 5), q.at_least("n", "m")
    ) == {
        "c.not_null": 1, "n.not_null": 1, "m.not_null": 0, "c.accepted": 2, "n.range": 2, "n.at_least.m": 1,
    }


def test_unique_rules(spark):
    df = spark.createDataFrame([("s", "a"), ("s", "a"), ("x", "a"), ("x", "b"), ("s", None), ("s", None)], "source string, id string")
    assert report(df, q.unique("id")) == {"id.unique": 1}
    assert report(df, q.unique("id", where=F.col("source") == "x")) == {"id.unique": 0}


def test_contracts(spark):
    fields = FCT_SKILL_DEMAND_DAILY.fields
    wrong = [
        (FCT_SKILL_DEMAND_DAILY, 0),
        (StructType(fields[:-1]), 1),
        (StructType([*fields, fields[0]]), 1),
        (StructType([fields[1], fields[0], *fields[2:]]), 2),
    ]
    for schema, failures in wrong:
        df = spark.createDataFrame([], schema)
        assert report(df, q.contract(FCT_SKILL_DEMAND_DAILY)) == {"contract": failures}


def test_suite_on_clean_and_dirty_postings(spark, capsys):
    good = ("a", "t", None, None, "DE", True, "u", T0, T0, T0)
    clean = spark.createDataFrame([good], FCT_POSTINGS)
    dirty = spark.createDataFrame([good, good, (None, None, None, None, "FR", None, None, None, None, None)], FCT_POSTINGS)
    rules = q.table_rules()
    assert q.gate(q.quality_report({"fct_postings": clean}, rules)) == 0
    assert q.gate(q.quality_report({"fct_postings": dirty}, rules)) == 1
    assert "fct_postings.posting_id.unique failed on 1" in capsys.readouterr().out
    assert rows(q.quality_report({"fct_postings": dirty}, rules).where("not passed"), "rule") == [
        (f"fct_postings.{r}",)
        for r in ("country_code.accepted", "last_seen_at.not_null", "posting_id.not_null", "posting_id.unique", "title.not_null")
    ]


def test_gate_without_a_warehouse(spark):
    assert q.warehouse_tables(spark, {"x": "nowhere.x"}) is None
    assert q.gate(None) == 2


def test_unreadable_ingestion_times_are_counted(spark):
    df = spark.createDataFrame([("s", "a", t, "{}", None, "2024-01-01", "00") for t in ("2024-01-01T00:00:00Z", "soon", None)], BRONZE)
    assert report(df, *q.bronze_rules()) == {"ingested_at.readable": 2}


def test_spoilt_tables_break_every_rule(spark):
    folder = Path(driver.SMALLEST).with_name("sf0.01")
    if not folder.exists():
        pytest.skip("no test tables")
    report = rows(driver.queries()["g_spoilt_report"](spark, str(folder)), "rule", "failed_rows")
    assert len(report) == 32 and all(n > 0 for _, n in report), report
