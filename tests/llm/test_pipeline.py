"""The corpus pipeline, stage by stage, on small tables with known cases."""

from __future__ import annotations

import corpus_pipeline as pipeline
from helpers import key, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect_and_leave_clean_documents(spark, tmp_path):
    leak = words(900, 25)
    clean = [(i, words(i, 150)) for i in range(20)]
    rows = [*clean, (50, clean[3][1]), (51, clean[3][1] + " tail"), (52, clean[3][1]), (52, clean[3][1]), (60, None), (61, "123 !!"), (62, ""), (70, f"{words(70, 40)} {leak} {words(71, 40)}"), (None, words(72, 90))]
    docs = spark.createDataFrame([(i, t, "xy" if (i or 1) % 3 else None, f"s{(i or 0) % 4}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [name for name, _ in pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixture", "token_ids"]
    assert pipeline.ORACLE_SQL is None
    now, seen = docs, {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        seen[name] = sorted((r.doc_id for r in now.collect()), key=lambda d: (d is not None, d))
        if name != "token_ids":
            assert now.columns == COLUMNS and [f.dataType for f in now.schema] == [f.dataType for f in docs.schema]
    ids = [*range(20)]
    assert seen["language"] == [None, *ids, 50, 51, 52, 52, 70]
    assert seen["near_duplicates"] == [None, *ids, 70]
    assert seen["decontamination"] == [None, *ids]
    assert set(seen["mixture"]) <= {None, *ids} and max(seen["mixture"].count(i) for i in ids) <= 2
    kept = spark.read.parquet(str(tmp_path / "decontamination")).collect()
    mixed = spark.read.parquet(str(tmp_path / "mixture")).collect()
    n_words = lambda found: sum(len(r.text.split()) for r in found)
    assert abs(n_words(mixed) - 1.5 * n_words(kept)) <= 4
    assert seen["token_ids"] == seen["mixture"]
    assert sorted(tuple(r) for r in kept if r.doc_id == 5) == [tuple(r) for r in docs.where("doc_id = 5").collect()]
    assert pipeline.run(spark, str(tmp_path)).count() == len(mixed)


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, row int, tie int")
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0
        if name != "token_ids":
            assert out.columns == docs.columns


def test_repeated_rows_stay_once_and_extra_columns_go_along(spark, tmp_path):
    rows = [(1, words(1, 50), "xy", "s", 9, "r1", 5), (1, words(1, 50), "xy", "s", 9, "r0", 5), (2, words(2, 50), "xy", None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string, tie int")
    out = pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert sorted(((r.doc_id, r.n_chars, r["row"], r.tie) for r in out.collect()), key=key) == [(1, 9, "r0", 5), (2, None, None, None)]
