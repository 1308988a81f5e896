from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from jobloom.functions import text


@pytest.fixture(scope="module")
def apply(spark):
    def run(fn, *values, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
        return [r[0] for r in df.orderBy("n").select(fn(F.col("v"))).collect()]

    return run


PLACES = {
    "Berlin, Germany": ("Berlin", "DE"),
    "MÜNCHEN": ("Munich", "DE"),
    "munich area": ("Munich", "DE"),
    "Köln": ("Cologne", "DE"),
    "Frankfurt am Main": ("Frankfurt", "DE"),
    "Wien, Austria": ("Vienna", "AT"),
    "Wien, Germany": ("Vienna", "DE"),
    "ZÜRICH": ("Zurich", "CH"),
    "Basel, Switzerland": ("Basel, Switzerland", "CH"),
    " Remote ": ("Remote", None),
    "Deutschland": ("Deutschland", None),
    "Hamburg or Berlin": ("Berlin", "DE"),
    "  ": (None, None),
    "": (None, None),
    None: (None, None),
}


def test_places(apply):
    assert apply(text.normalize_city, *PLACES) == [city for city, _ in PLACES.values()]
    assert apply(text.infer_country, *PLACES) == [country for _, country in PLACES.values()]


def test_rules_are_a_parameter(apply):
    assert apply(lambda c: text.infer_country(c, [("PL", ["warsaw"])]), "Warsaw", "Berlin") == ["PL", None]


SALARIES = {
    "50.000 - 60.000 €": "60.000",
    "€50,000 – €60,000": "",
    "65000 Euro": "",
    "70k EUR": "",
    "1050000 EUR": "050000",
    "65000 europe": "65000",
    "45000€ or 90000€": "45000",
    "from 55.000\n EUR": "55.000",
    "55.000 €": "",
    "55.000\x0b€": "",
    "": "",
    None: None,
}


def test_salary_text(apply):
    assert apply(text.extract_salary, *SALARIES) == list(SALARIES.values())


def test_salary_parsing_and_bands(apply):
    assert apply(text.parse_salary, "60.000", "60,000", "050000", "", "x", None) == [60000, 60000, 50000, None, None, None]
    values = [39999, 40000, 59999, 60000, 80000, 100000, 129999, 130000]
    assert apply(text.salary_band, *values, kind="int") == [
        "<40k", "40-60k", "40-60k", "60-80k", "80-100k", "100-130k", "100-130k", "130k+",
    ]


def test_tags_and_aliases(apply):
    assert apply(text.normalize_tag, '"Py"', " A b ", "", None) == ["py", " a b ", "", None]
    assert apply(text.normalize_alias, " Apache Spark ", "") == ["apache spark", ""]


def test_times(apply):
    assert apply(text.iso_to_timestamp, "2024-01-01T00:00:00Z", "2024-01-01T02:00:00.5+02:00", "soon", None) == [
        datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 500000), None, None,
    ]
    assert apply(text.epoch_to_timestamp, 1_700_000_000, 0, 10**15, None, kind="bigint") == [
        datetime(2023, 11, 14, 22, 13, 20), datetime(1970, 1, 1), None, None,
    ]
    moment = [datetime(2024, 1, 7, 23, 59), datetime(2024, 1, 8)]
    assert apply(text.day_of, *moment, kind="timestamp_ntz") == [datetime(2024, 1, 7), datetime(2024, 1, 8)]
    assert apply(text.week_of, *moment, kind="timestamp_ntz") == [datetime(2024, 1, 1), datetime(2024, 1, 8)]
    recent = lambda c: text.within_days(c, 30, date(2024, 1, 31))
    assert apply(recent, datetime(2024, 1, 1), datetime(2023, 12, 31, 23), None, kind="timestamp_ntz") == [True, False, None]


def test_small_functions(apply, spark):
    assert apply(text.or_unknown, "DE", None) == ["DE", "XX"]
    assert apply(lambda c: text.share(c, F.lit(4).cast("bigint")), 1, kind="bigint") == [0.25]
    assert apply(lambda c: text.share(F.lit(1), c), 0, kind="bigint") == [None]
    assert apply(lambda c: text.posting_key(c, F.lit("1")), "a", None) == ["a|1", None]
