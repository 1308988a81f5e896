"""A training corpus from raw documents: language, near-duplicates, benchmark leaks, mixture, token ids.

Every stage takes all documents its predecessor kept and works on them whole.  Stages but the last return the columns
they were given.  Rows are told apart by id and a hash of their text, so repeated and missing ids do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobloom.llm import decontaminate, language, mixing, simhash, token_files
from jobloom.llm.common import table, written
from jobloom.llm.queries import language_model

#: SQL has no language model, fingerprint links or seeded mixture; the stages are tested one by one instead.
ORACLE_SQL = None

_ID, _TIE = "_pipeline_id", "_pipeline_tie"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (null or without a letter) and fills a missing ``lang``."""
    model = language_model(docs.select("doc_id", "text", "lang"))
    found = language.identify(docs, model).where(F.col("lang_pred") != language.UNKNOWN)
    filled = {"lang": F.coalesce("row.lang", "lang_pred")}
    return found.select(*(filled.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints of four-word shingles at most four bits apart the smallest id stays."""
    found = simhash.near_duplicates(docs.select("doc_id", "text"), width=4, radius=2)
    stays = found.where("stays").select(F.col("doc_id").alias(_ID), F.col("tie").alias(_TIE)).distinct()
    keyed = _keyed(docs)
    kept = keyed.join(stays.withColumnsRenamed({_ID: "s_id", _TIE: "s_tie"}), F.col(_ID).eqNullSafe(F.col("s_id")) & (F.col(_TIE) == F.col("s_tie")), "left_semi")
    # Rows equal in id and text are one document; the rest of the row decides which one is kept.
    order = Window.partitionBy(_ID, _TIE).orderBy(*(F.col(f"row.`{c}`") for c in docs.columns if c not in ("doc_id", "text")))
    kept = kept.withColumn("_pipeline_n", F.row_number().over(order)).where("_pipeline_n = 1")
    return _unpacked(kept, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which ten consecutive words, or the whole, of a benchmark item occur."""
    found = decontaminate.find_items(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_tie")).distinct()
    hit = written(hit, "pipeline-hits")
    kept = _keyed(docs).join(hit, F.col(_ID).eqNullSafe(F.col("h_id")) & (F.col(_TIE) == F.col("h_tie")), "left_anti")
    return _unpacked(kept, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats, keeps or leaves out documents until each source has its target number of words."""
    return mixing.repeated(mixing.mix(docs), docs.columns, length_col="n_chars")


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the mixture as token-id files and returns what they hold, a row per document."""
    files, frequencies = token_files.write_ids(docs.select("doc_id", "text"))
    return token_files.read_ids(spark, files, frequencies)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixture", mix_sources),
    ("token_ids", write_token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def _keyed(docs: DataFrame) -> DataFrame:
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return docs.select(row, F.col("doc_id").cast("long").alias(_ID), F.xxhash64("text").alias(_TIE))


def _unpacked(keyed: DataFrame, docs: DataFrame) -> DataFrame:
    return keyed.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
