from __future__ import annotations

import json

import pytest

from jobloom.functions.contract import FIELD_RULES, validate_contract

MINIMAL = {"slug": "m-1", "company_name": "Kelp & Co", "title": "Diver", "url": "https://kelp.example.net/m-1", "created_at": 1_698_765_432}


@pytest.fixture(scope="module")
def check(spark):
    def run(*payloads):
        texts = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
        df = spark.createDataFrame(list(enumerate(texts)), "n int, raw string")
        out = validate_contract(df).orderBy("n").collect()
        return [(json.loads(r.typed) if r.typed is not None else None, r.contract_error) for r in out]

    return run


def test_minimal_record_gets_defaults(check):
    [(typed, error)] = check(MINIMAL)
    assert error is None
    assert typed == {**MINIMAL, "description": "", "remote": False, "tags": [], "job_types": [], "location": ""}
    assert list(typed) == list(FIELD_RULES)


def test_scalar_tags_become_a_list(check):
    assert check({**MINIMAL, "tags": "sea urchin"})[0][0]["tags"] == ["sea urchin"]
    assert check({**MINIMAL, "tags": 7})[0][0]["tags"] == ["7"]


def test_lists(check):
    got = check(
        {**MINIMAL, "tags": [" a ", None, 3, True, {"k": 1}], "job_types": None},
        {**MINIMAL, "tags": []},
    )
    assert got[0][0]["tags"] == ["a", "3", "true", '{"k":1}']
    assert got[0][0]["job_types"] == []
    assert got[1][0]["tags"] == []


INVALID = [
    ("slug", 5), ("slug", None), ("title", ["a"]), ("location", None), ("description", None),
    ("remote", None), ("remote", 2), ("remote", ""), ("remote", "maybe"), ("remote", []), ("remote", " true"),
    ("created_at", 1.5), ("created_at", None), ("created_at", "soon"), ("created_at", "1__0"), ("created_at", 10**20), ("created_at", {}),
]


def test_invalid_fields(check):
    got = check(*[{**MINIMAL, field: value} for field, value in INVALID])
    assert got == [(None, field) for field, _ in INVALID]


FLAGS = [
    (True, True), ("TRUE", True), ("yes", True), ("on", True), ("T", True), (1, True), (1.0, True), ("1", True),
    (False, False), ("off", False), ("N", False), (0, False), (0.0, False),
]


def test_boolean_coercion(check):
    got = check(*[{**MINIMAL, "remote": value} for value, _ in FLAGS])
    assert [typed["remote"] for typed, _ in got] == [expected for _, expected in FLAGS]


INTEGERS = [("1698765432", 1_698_765_432), (" 5 ", 5), (1.0, 1), ("1.0", 1), (True, 1), ("1_000", 1000), ("-3", -3), (1e9, 10**9)]


def test_integer_coercion(check):
    got = check(*[{**MINIMAL, "created_at": value} for value, _ in INTEGERS])
    assert [typed["created_at"] for typed, _ in got] == [expected for _, expected in INTEGERS]


def test_missing_fields_are_named_in_order(check):
    assert check({"slug": "broken"}) == [(None, "company_name,title,url,created_at")]


def test_texts_are_stripped_and_unknown_keys_ignored(check):
    [(typed, _)] = check({**MINIMAL, "title": " \t Ärztin \n", "slug": "", "extra": {"a": 1}})
    assert typed["title"] == "Ärztin"
    assert typed["slug"] == ""
    assert "extra" not in typed


def test_payloads_that_are_no_object(check):
    texts = ["[1]", '"s"', "5", "null", "no json", "", '{"slug":1} x', json.dumps(MINIMAL) * 2, json.dumps([MINIMAL])]
    assert check(*texts) == [(None, "payload")] * len(texts)


def test_null_payload_keeps_its_row(spark):
    df = spark.createDataFrame([(1, None)], "n int, raw string")
    assert [tuple(r) for r in validate_contract(df).collect()] == [(1, None, None, "payload")]
