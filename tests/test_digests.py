"""Digests that prove a rerun and find the parts that differ (Q8)."""

from __future__ import annotations

from datetime import datetime

import pytest

from conftest import rows
from jobloom.operators.diff import differing_parts, digests, located_changes

SCHEMA = "id long, a string, b string, t timestamp_ntz, tags array<string>"
T = datetime(2024, 1, 1)


def frame(spark, *records):
    return spark.createDataFrame(list(records), SCHEMA)


BASE = [(i, f"v{i}", None if i % 3 else "x", T, ["p", None]) for i in range(200)]


def test_order_layout_and_column_order_do_not_matter(spark):
    one = frame(spark, *BASE).repartition(7)
    other = frame(spark, *reversed(BASE)).select("tags", "t", "b", "a", "id").coalesce(1)
    assert rows(digests(one, ["id"], 16)) == rows(digests(other, ["id"], 16))
    assert differing_parts(digests(one, ["id"]), digests(other, ["id"])).count() == 0


@pytest.mark.parametrize(
    "change",
    [
        lambda r: [(7, "other", *r[7][2:]) if x[0] == 7 else x for x in r],
        lambda r: [(7, r[7][2], r[7][1], *r[7][3:]) if x[0] == 7 else x for x in r],  # a null changes its column
        lambda r: [x for x in r if x[0] != 7],
        lambda r: [*r, r[7]],
        lambda r: [*r, (None, None, None, None, None)],
    ],
)
def test_a_change_is_found_in_its_part_alone(spark, change):
    before, after = frame(spark, *BASE), frame(spark, *change(BASE))
    parts = differing_parts(digests(before, ["id"]), digests(after, ["id"]))
    assert parts.count() == 1
    found = located_changes(before, after, parts, ["id"])
    key = lambda r: (r[0], r[1], r[2], r[3], None if r[4] is None else tuple(r[4]))
    a, b = [key(r) for r in BASE], [key(r) for r in change(BASE)]
    want = {r: (max(a.count(r) - b.count(r), 0), max(b.count(r) - a.count(r), 0)) for r in {*a, *b} if a.count(r) != b.count(r)}
    assert {key(r): (r.only_in_a, r.only_in_b) for r in found.collect()} == want


def test_ignored_columns_and_empty_tables(spark):
    before, after = frame(spark, *BASE), frame(spark, *[(*r[:3], datetime(2025, 1, 1), r[4]) for r in BASE])
    assert differing_parts(digests(before, ["id"]), digests(after, ["id"])).count() > 100
    assert differing_parts(digests(before, ["id"], ignore=["t"]), digests(after, ["id"], ignore=["t"])).count() == 0
    nothing = frame(spark)
    assert digests(nothing, ["id"]).count() == 0
    parts = differing_parts(digests(before, ["id"], 8), digests(nothing, ["id"], 8))
    assert parts.count() == 8
    assert located_changes(before, nothing, parts, ["id"], 8).count() == 200
