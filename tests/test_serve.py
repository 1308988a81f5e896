from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from conftest import rows
from jobloom.plans import serve
from jobloom.schemas import FCT_POSTINGS, FCT_SKILL_DEMAND_DAILY

T0 = datetime(2024, 1, 1)
AS_OF = date(2024, 1, 31)


def day(n):
    return T0 + timedelta(days=n)


@pytest.fixture(scope="module")
def board(spark):
    records = [
        # id, country, remote, created
        ("a", "DE", True, 1),
        ("b", "DE", False, 2),
        ("c", "AT", True, None),
        ("d", None, True, 3),
        ("e", "DE", None, 4),
    ]
    fct = spark.createDataFrame(
        [
            (i, f"t{i}", "co" if i < "c" else None, "city", c, r, "u", None if n is None else day(n), T0, None)
            for i, c, r, n in records
        ],
        FCT_POSTINGS,
    )
    tags = spark.createDataFrame(
        [("a", "py"), ("a", "python"), ("b", "python"), ("d", "sql"), ("c", "py"), ("gone", "py")], "source_id string, tag string"
    )
    skills = spark.createDataFrame([("python", "py"), ("python", "python"), ("sql", "sql")], "skill string, alias string")
    return fct, tags, skills


def ids(df):
    return [r.posting_id for r in df.collect()]


def test_newest_postings_with_nulls_last(board):
    assert ids(serve.list_postings(*board)) == ["e", "d", "b", "a", "c"]
    assert ids(serve.list_postings(*board, limit=2)) == ["e", "d"]
    assert serve.list_postings(*board).columns == serve.POSTING_COLUMNS


def test_posting_conditions(board):
    assert ids(serve.list_postings(*board, country="DE")) == ["e", "b", "a"]
    assert ids(serve.list_postings(*board, remote=True)) == ["d", "a", "c"]
    assert ids(serve.list_postings(*board, remote=False, country="DE")) == ["b"]


def test_a_posting_appears_once_per_matching_tag(board):
    assert ids(serve.list_postings(*board, skill="Python")) == ["b", "a", "a", "c"]
    assert ids(serve.list_postings(*board, skill="python", limit=2)) == ["b", "a"]
    assert ids(serve.list_postings(*board, skill="python", limit=3)) == ["b", "a", "a"]
    assert ids(serve.list_postings(*board, skill="python", distinct=True)) == ["b", "a", "c"]
    assert ids(serve.list_postings(*board, skill="cobol")) == []


@pytest.mark.parametrize("bad", [{"country": "FR"}, {"country": "de"}, {"limit": 0}, {"limit": 501}])
def test_posting_parameters_are_checked(board, bad):
    with pytest.raises(ValueError):
        serve.list_postings(*board, **bad)


@pytest.fixture(scope="module")
def demand(spark):
    records = [
        (day(0), "python", "DE", 5, 1),
        (day(0), "python", "DE", 2, 0),
        (day(0), "python", None, 7, 0),
        (day(1), "sql", "AT", 7, 7),
        (day(-1), "spark", "DE", 99, 0),
    ]
    return spark.createDataFrame(records, FCT_SKILL_DEMAND_DAILY)


def test_top_cells(demand):
    out = serve.top_skills(demand, AS_OF)
    assert [tuple(r) for r in out.collect()] == [
        ("2024-01-01 00:00:00", "python", "DE", 7),
        ("2024-01-01 00:00:00", "python", None, 7),
        ("2024-01-02 00:00:00", "sql", "AT", 7),
    ]
    assert dict(out.dtypes)["posting_count"] == "int"
    assert [r.skill for r in serve.top_skills(demand, AS_OF, days=31, country="DE", limit=1).collect()] == ["spark"]
    for bad in ({"days": 0}, {"days": 366}, {"limit": 201}, {"country": "XX"}):
        with pytest.raises(ValueError):
            serve.top_skills(demand, AS_OF, **bad)


def test_top_skills_total_and_names(demand):
    assert [tuple(r) for r in serve.top_skills_total(demand, AS_OF).collect()] == [("python", 14), ("sql", 7)]
    assert serve.top_skills_total(demand).count() == 0
    assert [r.skill for r in serve.skill_names(demand).collect()] == ["python", "spark", "sql"]


def test_series(demand):
    assert [tuple(r) for r in serve.skill_series(demand, ["python", "sql"]).collect()] == [
        (day(0), "python", 14),
        (day(1), "sql", 7),
    ]
    assert [tuple(r) for r in serve.skill_series(demand, ["python"], country="DE").collect()] == [(day(0), "python", 7)]
    assert serve.skill_series(demand).count() == 3
    with pytest.raises(ValueError):
        serve.skill_series(demand, [])


def test_totals(board, spark):
    assert rows(serve.totals(board[0])) == [(5, 3, 1, 2)]
    assert rows(serve.totals(board[0].limit(0))) == [(0, 0, 0, 0)]


def test_weekly_share_is_a_ratio_of_sums(spark):
    schema = "posting_date timestamp_ntz, country_code string, posting_count bigint, remote_count bigint, remote_share double"
    daily = spark.createDataFrame(
        [(day(0), "DE", 9, 0, 0.0), (day(6), "DE", 1, 1, 1.0), (day(7), "CH", 2, 1, 0.5), (day(0), "XX", 5, 5, 1.0)], schema
    )
    assert [tuple(r) for r in serve.weekly_remote_share(daily).collect()] == [(day(0), "DE", 0.1), (day(7), "CH", 0.5)]
    wide = serve.weekly_remote_share(daily, pivot=True)
    assert wide.columns == ["week", "DE", "AT", "CH"]
    assert [tuple(r) for r in wide.collect()] == [(day(0), 0.1, None, None), (day(7), None, None, 0.5)]


def test_top_companies(spark):
    schema = (
        "company_name string, posting_count bigint, remote_posting_count bigint, de_posting_count bigint, "
        "at_posting_count bigint, ch_posting_count bigint, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz"
    )
    dim = spark.createDataFrame([(n, c, 0, 0, 0, 0, T0, T0) for n, c in [("b", 2), ("a", 2), ("z", 9)]], schema)
    out = serve.top_companies(dim, limit=2)
    assert [r.company_name for r in out.collect()] == ["z", "a"]
    assert len(out.columns) == 7
