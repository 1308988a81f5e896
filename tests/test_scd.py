from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from conftest import rows
from jobloom.operators.scd import OBSERVED, scd2_apply, scd2_as_of, scd2_from_history
from jobloom.schemas import SILVER_POSTINGS, SNAPSHOT

LOG = (
    "source string, source_id string, slug string, title string, company_name string, remote boolean, "
    f"location string, {OBSERVED} timestamp_ntz, n int"
)
T0 = datetime(2024, 1, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def seen(source_id, minute, n=0, title="t", company="c", remote=True, location="l", slug="s"):
    return ("board", source_id, slug, title, company, remote, location, at(minute), n)


def brute_force(log):
    """Versions of each key by a plain walk over its sorted observations."""
    out = []
    for key in sorted({r[1] for r in log}):
        versions = []
        for r in sorted((r for r in log if r[1] == key), key=lambda r: (r[7], r[8])):
            if not versions or versions[-1][3:7] != r[3:7]:
                versions.append(r)
        ends = [v[7] for v in versions[1:]] + [None]
        out += [(key, v[3], v[5], v[6], v[8], v[7], end) for v, end in zip(versions, ends, strict=True)]
    return sorted(out, key=lambda r: (r[0], r[5], r[4]))


def versions(df):
    picked = df.select("source_id", "title", "remote", "location", "n", "valid_from", "valid_to").collect()
    return sorted((tuple(r) for r in picked), key=lambda r: (r[0], r[5], r[4]))


def random_log(seed, size, keys, spread, changes):
    rng = random.Random(seed)
    log = []
    for n in range(size):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(keys)}"
        log.append(
            seen(
                key,
                rng.randrange(spread) / 4,
                n,
                title=rng.choice([None, "a", "b"]) if rng.random() < changes else "a",
                remote=rng.choice([None, True]) if rng.random() < changes else True,
                slug=str(n),
            )
        )
    return log


@pytest.mark.parametrize("grain", ["minute", "hour", "day", "week"])
@pytest.mark.parametrize(("spread", "changes"), [(40, 0.9), (2000, 0.05), (3, 0.5)])
def test_history_equals_a_plain_walk(spark, grain, spread, changes):
    log = random_log(spread, 1500, 6, spread, changes)
    df = spark.createDataFrame(log, LOG).repartition(5)
    assert versions(scd2_from_history(df, order=[OBSERVED, "n"], grain=grain)) == brute_force(log)


def test_history_in_sampled_ranges(spark):
    # Every observation of the hot key carries one timestamp.
    log = random_log(1, 1500, 3, 1, 0.5) + random_log(2, 500, 3, 900, 0.2)
    log = [(*r[:8], i) for i, r in enumerate(log)]
    df = spark.createDataFrame(log, LOG)
    assert versions(scd2_from_history(df, order=[OBSERVED, "n"], ranges=7)) == brute_force(log)


def test_change_and_back_makes_three_versions(spark):
    log = [seen("a", 0), seen("a", 60, title="u"), seen("a", 61, title="u", slug="z"), seen("a", 120)]
    got = versions(scd2_from_history(spark.createDataFrame(log, LOG), order=[OBSERVED, "n"]))
    assert [(r[1], r[5], r[6]) for r in got] == [("t", at(0), at(60)), ("u", at(60), at(120)), ("t", at(120), None)]


def test_intervals_do_not_overlap_and_one_is_open(spark):
    history = scd2_from_history(spark.createDataFrame(random_log(3, 800, 4, 300, 0.5), LOG), order=[OBSERVED, "n"])
    by_key = {}
    for r in history.collect():
        by_key.setdefault(r.source_id, []).append((r.valid_from, r.valid_to))
    for spans in by_key.values():
        spans.sort(key=lambda s: (s[0], s[1] or datetime.max))
        assert [s[1] for s in spans[:-1]] == [s[0] for s in spans[1:]]
        assert spans[-1][1] is None


def history_of(spark, *records):
    return spark.createDataFrame(list(records), SNAPSHOT)


def version(source_id, title, start, end):
    return ("board", source_id, "s", title, "c", True, None, at(start), at(start), None if end is None else at(end))


def current_of(spark, **titles):
    records = [("board", k, "s2", t, "c", True, None, at(90)) for k, t in titles.items()]
    return spark.createDataFrame(records, LOG.rpartition(",")[0])


def test_apply_opens_closes_and_leaves_alone(spark):
    history = history_of(spark, version("a", "old", 0, 5), version("a", "t", 5, None), version("b", "t", 0, None), version("gone", "t", 0, None))
    out = scd2_apply(history, current_of(spark, a="t", b="u", c="n"), at(100))
    assert out.schema.fieldNames() == SNAPSHOT.fieldNames()
    assert rows(out, "source_id", "title", "slug", "valid_from", "valid_to") == [
        ("a", "old", "s", at(0), at(5)),
        ("a", "t", "s", at(5), None),
        ("b", "t", "s", at(0), at(100)),
        ("b", "u", "s2", at(100), None),
        ("c", "n", "s2", at(100), None),
        ("gone", "t", "s", at(0), None),
    ]


def test_apply_of_the_same_state_writes_nothing(spark):
    history = history_of(spark, version("a", "t", 0, None), version("b", None, 0, None))
    current = current_of(spark, a="t", b=None)
    assert rows(scd2_apply(history, current, at(100))) == rows(history)


def test_as_of(spark):
    history = history_of(spark, version("a", "old", 0, 5), version("a", "new", 5, None), version("b", "t", 3, None))
    assert rows(scd2_as_of(history, at(0)), "source_id", "title") == [("a", "old")]
    assert rows(scd2_as_of(history, at(5)), "source_id", "title") == [("a", "new"), ("b", "t")]
    assert scd2_as_of(history, at(-1)).count() == 0
