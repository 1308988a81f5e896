from __future__ import annotations

import json
from datetime import UTC, date, datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import rows
from jobloom.functions.contract import validate_contract
from jobloom.sources.bronze import expire_partitions, read_bronze, write_bronze
from jobloom.sources.messages import bronze_rows, parse_messages
from jobloom.sources.pages import build_envelope, kafka_sink_options, publish, rederive, to_messages, unroll_pages
from jobloom.sources.taxonomy import SKILLS, default_seed, read_seed
from jobloom.streaming import drain as streaming
from jobloom.streaming.drain import drain, drain_metrics, message_stream, read_metrics, replay_window, window_options

NOW = datetime(2024, 1, 31, 9, 30, tzinfo=UTC)
GOOD = {
    "slug": "graz-17",
    "company_name": "Nordlicht Verlag",
    "title": "Archive Analyst",
    "description": "Sort old maps.",
    "remote": False,
    "url": "https://stellen.example.org/graz-17",
    "tags": ["scala", "kafka"],
    "job_types": ["half-days"],
    "location": "Graz",
    "created_at": 1_712_345_678,
}


def pages(spark, *payloads):
    texts = [(i + 1, p if p is None or isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(texts, "page int, payload string")


def slugs(items):
    return rows(items.select("page", F.get_json_object("raw", "$.slug")))


# --- pages ------------------------------------------------------------------


def test_walk_stops_at_the_first_empty_page(spark):
    got = unroll_pages(pages(spark, {"data": [{"slug": "linz-3"}, GOOD]}, {"data": []}, {"data": [{"slug": "unseen"}]}))
    assert slugs(got) == [(1, "graz-17"), (1, "linz-3")]


def test_every_kind_of_end(spark):
    for end in [{}, {"data": None}, {"data": "x"}, {"data": {"a": 1}}, "broken", None]:
        assert slugs(unroll_pages(pages(spark, {"data": [GOOD]}, end, {"data": [GOOD]}))) == [(1, "graz-17")]


def test_page_limit_and_empty_first_page(spark):
    landed = pages(spark, *[{"data": [{"slug": str(i)}]} for i in range(12)])
    assert unroll_pages(landed).count() == 12
    assert unroll_pages(landed, max_pages=3).count() == 3
    assert unroll_pages(pages(spark, {"data": []}, {"data": [GOOD]})).count() == 0
    with pytest.raises(ValueError):
        unroll_pages(landed, max_pages=0)


def test_items_that_are_no_object_are_counted(spark):
    seen = Observation()
    items = unroll_pages(pages(spark, {"data": [GOOD, 5, None, "x"]}), observe=seen)
    assert items.count() == 1
    assert seen.get == {"items": 4, "bad_items": 3}


def test_drifted_posting_keeps_its_payload(spark):
    bad = {"slug": "wels-8", "wage": {"from": [1, None]}}
    typed = validate_contract(unroll_pages(pages(spark, {"data": [bad, GOOD]}, {"data": []})))
    got = {r.source_id: r for r in build_envelope(typed, "board", NOW).collect()}
    assert got["wels-8"].typed is None
    assert json.loads(got["wels-8"].source_payload) == bad
    assert json.loads(got["graz-17"].typed) == GOOD
    assert got["graz-17"].ingested_at == "2024-01-31T09:30:00.000000Z"


def test_envelope_ids(spark):
    raws = [{"slug": " a "}, {}, {"slug": None}, {"slug": 5}]
    df = spark.createDataFrame([(json.dumps(r), None) for r in raws], "raw string, typed string")
    assert [r.source_id for r in build_envelope(df, "board", NOW).collect()] == [" a ", "", "", "5"]


def test_message_key_and_value(spark):
    envelope = [("board", "ä\"1", "t", '{"a":[1,null],"b":1.50}', None), ("board", "", "t", "{}", '{"slug":"x"}')]
    df = spark.createDataFrame(envelope, "source string, source_id string, ingested_at string, source_payload string, typed string")
    got = [(bytes(r.key), json.loads(bytes(r.value))) for r in to_messages(df).collect()]
    assert got[0] == (
        'ä"1'.encode(),
        {"source": "board", "source_id": 'ä"1', "ingested_at": "t", "source_payload": {"a": [1, None], "b": 1.5}, "typed": None},
    )
    assert got[1][0] == b"unknown"
    assert got[1][1]["typed"] == {"slug": "x"}


def test_sink_options():
    options = kafka_sink_options("broker:9092", topic="other")
    assert options["kafka.acks"] == "all"
    assert options["kafka.enable.idempotence"] == "true"
    assert options["kafka.compression.type"] == "zstd"
    assert options["kafka.linger.ms"] == "50"
    assert options["topic"] == "other"
    assert "kafka.batch.num.messages" not in options


# --- messages ----------------------------------------------------------------


def message(**members):
    return json.dumps({"source": "board", "source_id": "a", "ingested_at": "2024-01-01T00:00:00Z", **members})


def parsed(spark, *values):
    df = spark.createDataFrame(list(enumerate(values)), "n int, value string")
    return parse_messages(df.orderBy("n").coalesce(1), "board").collect()


def test_bad_and_foreign_messages(spark):
    got = parsed(
        spark, message(), "not json", "[1]", "", '"s"', "null", message(source="other"), message(source=None), message() * 2,
        "{'source':'board'}", message() + " tail", "[" + message() + "]",
    )
    assert [(r.bad, r.other_source) for r in got] == [
        (False, False), (True, False), (True, False), (True, False), (True, False), (True, False), (False, True), (False, True),
        (True, False), (True, False), (True, False), (True, False),
    ]
    assert got[1].source_payload is None


def test_members_of_a_message(spark):
    got = parsed(
        spark,
        message(source_payload={"b": [1, None], "a": "ü"}, typed={"slug": "x"}),
        message(typed={}),
        message(typed=None, source_payload=None),
        message(typed=[], source_payload=[1]),
        message(typed="", source_payload="x"),
        message(typed="x"),
    )
    assert json.loads(got[0].source_payload) == {"b": [1, None], "a": "ü"}
    assert json.loads(got[0].typed) == {"slug": "x"}
    assert [r.typed for r in got[1:]] == [None, None, None, None, '"x"']
    assert [r.source_payload for r in got[1:]] == ["{}", "null", "[1]", '"x"', "{}"]


# --- bronze ------------------------------------------------------------------


def landed(spark):
    values = [message(source_payload=GOOD, typed=GOOD), message(source="other"), "bad", message(source_payload={"slug": "b"})]
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_bronze_round_trip_and_metrics(spark, tmp_path):
    root = str(tmp_path / "bronze")
    metrics = write_bronze(parse_messages(landed(spark), "board"), root, NOW)
    assert (metrics.row_count, metrics.bad_messages, metrics.other_source, metrics.skipped) == (2, 1, 1, False)
    assert metrics.payload_bytes > 0
    back = read_bronze(spark, root)
    assert rows(back, "source", "ingest_date", "hour") == [("board", "2024-01-31", "09")] * 2
    write_bronze(parse_messages(landed(spark), "board"), root, datetime(2024, 2, 1, tzinfo=UTC))
    assert back.sparkSession.read.parquet(root).count() == 4
    assert read_bronze(spark, root, since=date(2024, 2, 1)).count() == 2
    assert "ingest_date" in read_bronze(spark, root, since=date(2024, 2, 1))._jdf.queryExecution().executedPlan().toString()


def test_a_repeated_run_replaces_itself(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for _ in range(2):
        write_bronze(parse_messages(landed(spark), "board"), root, NOW, run="r1")
    assert read_bronze(spark, root).count() == 2


def test_nothing_to_write_is_skipped(spark, tmp_path):
    metrics = write_bronze(parse_messages(landed(spark).limit(0), "board"), str(tmp_path / "bronze"), NOW)
    assert metrics.skipped
    assert metrics.payload_bytes == 0


def test_rederive_applies_the_contract_to_stored_payloads(spark):
    bronze = bronze_rows(parse_messages(landed(spark), "board"))
    got = {json.loads(r.source_payload)["slug"]: r for r in rederive(bronze).collect()}
    assert json.loads(got["graz-17"].typed) == GOOD
    assert got["b"].typed is None
    assert got["b"].contract_error == "company_name,title,url,created_at"


def test_retention_keeps_the_last_days(spark):
    df = spark.createDataFrame([("2023-11-02",), ("2023-11-03",), ("2024-02-01",)], "ingest_date string")
    assert rows(expire_partitions(df, date(2024, 2, 1))) == [("2023-11-03",), ("2024-02-01",)]


# --- streaming ----------------------------------------------------------------


def test_drain_takes_each_message_once(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("topic", "bronze", "checkpoint"))
    typed = validate_contract(unroll_pages(pages(spark, {"data": [GOOD, {"slug": "b"}]})))
    envelopes = build_envelope(typed, "board", NOW)
    publish(envelopes, {"path": source}, fmt="parquet")

    def run(at=checkpoint):
        drain(message_stream(spark, {"path": source}, fmt="parquet", max_per_batch=1), "board", root, at, NOW).awaitTermination()
        return drain_metrics(spark, root, at)

    assert run()["row_count"] == 2
    assert run()["row_count"] == 2
    publish(envelopes.limit(1), {"path": source}, fmt="parquet")
    assert run()["row_count"] == 3
    assert read_bronze(spark, root).count() == 3
    # A new checkpoint replays everything as further rows.
    assert run(str(tmp_path / "replay"))["row_count"] == 3
    assert read_bronze(spark, root).count() == 6
    assert drain_metrics(spark, root)["row_count"] == 6


def test_drain_skips_null_values_and_counts_bad_ones(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("topic", "bronze", "checkpoint"))
    values = [(None, None), (None, b"bad"), (None, message().encode()), (None, message(source="other").encode())]
    spark.createDataFrame(values, "key binary, value binary").write.parquet(source)
    drain(message_stream(spark, {"path": source}, fmt="parquet"), "board", root, checkpoint).awaitTermination()
    metrics = drain_metrics(spark, root)
    assert (metrics["row_count"], metrics["bad_messages"], metrics["other_source"]) == (1, 1, 1)


def test_a_drain_computes_a_derived_value_once(spark, tmp_path, capsys):
    topic, root = str(tmp_path / "topic"), str(tmp_path / "bronze")
    spark.createDataFrame([(message(),), (None,), ("bad",)], "text string").write.parquet(topic)
    stream = spark.readStream.schema("text string").parquet(topic).select(F.initcap(F.reverse(F.reverse("text"))).alias("value"))
    lowered = stream.select(F.lower("value").alias("value"))
    query = drain(lowered, "board", root, str(tmp_path / "checkpoint"), NOW)
    query.awaitTermination()
    assert drain_metrics(spark, root)["row_count"] == 1 and drain_metrics(spark, root)["bad_messages"] == 1
    capsys.readouterr()
    query.explain()
    assert capsys.readouterr().out.count("initcap(") == 1


@pytest.mark.parametrize("dying", ["append_run", "_record"])
def test_counters_of_a_killed_drain_equal_those_of_one_run(spark, tmp_path, monkeypatch, dying):
    topic = str(tmp_path / "topic")
    for i in range(4):
        values = [(None, message(source_id=f"{i}-{k}").encode()) for k in range(i + 1)] + [(None, b"bad"), (None, message(source="x").encode())]
        spark.createDataFrame(values, "key binary, value binary").coalesce(1).write.mode("append").parquet(topic)
    start = lambda name: drain(message_stream(spark, {"path": topic}, fmt="parquet", max_per_batch=1), "board", str(tmp_path / name), str(tmp_path / f"{name}-c"), NOW)
    start("once").awaitTermination()
    real, calls = getattr(streaming, dying), []

    def dies_once(*args):
        real(*args)
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("killed")

    monkeypatch.setattr(streaming, dying, dies_once)
    with pytest.raises(StreamingQueryException):
        start("killed").awaitTermination()
    monkeypatch.undo()
    start("killed").awaitTermination()
    counted = [drain_metrics(spark, str(tmp_path / name)) for name in ("once", "killed")]
    assert counted[0] == counted[1]
    assert (counted[0]["row_count"], counted[0]["bad_messages"], counted[0]["other_source"]) == (10, 4, 4)
    per_batch = [rows(read_metrics(spark, str(tmp_path / name)), "batch", "row_count") for name in ("once", "killed")]
    assert per_batch[0] == per_batch[1] and len(per_batch[0]) == 4
    assert read_bronze(spark, str(tmp_path / "killed")).count() == 10


def test_a_window_of_a_topic_is_replayed(spark, tmp_path):
    topic, root = str(tmp_path / "topic"), str(tmp_path / "bronze")
    at = lambda hour, minute=0: datetime(2024, 1, 1, hour, minute, tzinfo=UTC)
    sent = [(None, message(source_id=f"h{h}").encode(), at(h)) for h in range(6)] + [(None, None, at(3)), (None, b"bad", at(3, 59))]
    spark.createDataFrame(sent, "key binary, value binary, timestamp timestamp").write.parquet(topic)
    replay = lambda **more: replay_window(spark, {"path": topic}, "board", root, at(2), at(4), "parquet", NOW, **more)
    done = replay(run="one")
    assert (done.row_count, done.bad_messages) == (2, 1)
    assert rows(read_bronze(spark, root), "source_id") == [("h2",), ("h3",)]
    replay(run="one")
    assert read_bronze(spark, root).count() == 2
    replay()
    assert read_bronze(spark, root).count() == 4
    assert replay_window(spark, {"path": topic}, "board", root, at(9), at(10), "parquet", NOW).skipped
    assert window_options(at(2), at(4)) == {"startingTimestamp": "1704074400000", "endingTimestamp": "1704081600000", "startingOffsetsByTimestampStrategy": "latest"}


# --- seed -------------------------------------------------------------------------


def test_seed_file_and_built_in_seed_agree(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("canonical,aliases\n" + "".join(f"{a},{b}\n" for a, b in SKILLS))
    assert rows(read_seed(spark, str(path))) == rows(default_seed(spark))
    assert len(SKILLS) == 35
