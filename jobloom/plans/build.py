"""The build order of all tables, whole or for the days a batch has touched."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.functions.text import day_of
from jobloom.operators.diff import table_diff
from jobloom.operators.gold import (
    dim_company,
    dim_skill,
    fct_postings,
    remote_policy_daily,
    salary_mentions,
    skill_demand_of,
)
from jobloom.operators.postings import posting_tags, silver_postings, staging
from jobloom.operators.quality import bronze_rules, check, gate, quality_report, table_rules, warehouse_tables
from jobloom.plans.tables import build_daily, materialize, observe_run, publish, rebuild_days, version_of, write_version
from jobloom.schemas import POSTING_KEY, SILVER_POSTINGS

TABLES: Mapping[str, str] = {
    "silver_postings": "silver.silver_postings",
    "silver_posting_tags": "silver.silver_posting_tags",
    "snp_postings": "snapshots.snp_postings",
    "dim_skill": "gold.dim_skill",
    "dim_company": "gold.dim_company",
    "fct_postings": "gold.fct_postings",
    "fct_skill_demand_daily": "gold.fct_skill_demand_daily",
    "fct_remote_policy_daily": "gold.fct_remote_policy_daily",
    "fct_salary_mentions": "gold.fct_salary_mentions",
}
STAGING_VIEW = "stg_postings"
# Days whose gold rows a build is about to replace.
_PENDING = "pending_days"
_DAY = "posting_date"
# The columns of silver that the daily tables depend on.
_DAILY_INPUT = ("posting_created_at", "country_code", "remote", "tags_json")


def tables_below(prefix: str) -> dict[str, str]:
    """The names of all tables in databases that begin with ``prefix``, for a second warehouse in one catalog."""
    return {short: prefix + name for short, name in TABLES.items()}


def changed_days(before: DataFrame, after: DataFrame) -> DataFrame:
    """The days whose daily rows differ between two states of silver: one column, ``posting_date``.

    A posting that moves from one day to another touches both.  Both sides have one row per key; stored in equal buckets
    of the keys they meet without a shuffle.
    """
    side = lambda df: df.select(*POSTING_KEY, F.struct(*_DAILY_INPUT).alias("_row"))
    a, b = side(before).alias("a"), side(after).alias("b")
    met = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in POSTING_KEY], "full_outer")
    differing = met.where(~F.col("a._row").eqNullSafe(F.col("b._row")))
    day = lambda s: F.when(F.col(f"{s}._row").isNotNull(), F.struct(day_of(F.col(f"{s}._row.posting_created_at")).alias(_DAY)))
    return differing.select(F.inline(F.array_compact(F.array(day("a"), day("b"))))).distinct()


def build(
    spark: SparkSession,
    bronze: DataFrame,
    seed: DataFrame,
    run_ts: datetime,
    buckets: int | None = None,
    names: Mapping[str, str] = TABLES,
    full: bool = False,
) -> dict[str, DataFrame]:
    """Action: staging view, then silver, snapshot and gold tables, each from the one before.

    Every gold table reads the written silver table, so the log is deduplicated once.  ``buckets`` co-locates silver with
    its history and with the silver before.  The daily tables are rewritten for the days that differ from the last
    finished build only, unless ``full``, the first build, or another taxonomy.  Those days are noted first and forgotten
    at the end, so the build after one that died takes them up again.
    """
    staged = materialize(staging(bronze), STAGING_VIEW, kind="view")
    silver_name, skill_name = names["silver_postings"], names["dim_skill"]
    version = write_version(silver_postings(staged), silver_name, buckets)
    silver = spark.table(version).select(*SILVER_POSTINGS.fieldNames())
    taxonomy = dim_skill(seed)
    daily = {
        "fct_skill_demand_daily": lambda rows: skill_demand_of(rows, taxonomy),
        "fct_remote_policy_daily": remote_policy_daily,
    }
    pending = names["fct_skill_demand_daily"].rpartition(".")[0] + f".{_PENDING}"
    stored = all(version_of(spark, names[n]) for n in ("silver_postings", "dim_skill", *daily))
    whole = full or not stored
    if not whole:
        compared = table_diff(spark.table(skill_name), taxonomy).first()
        whole = bool(compared.only_in_a or compared.only_in_b)
    created = day_of(F.col("posting_created_at"))
    if stored:
        before = spark.table(silver_name)
        days = changed_days(before, silver) if not whole else before.select(created.alias(_DAY)).union(silver.select(created.alias(_DAY)))
        if spark.catalog.tableExists(pending):
            days = days.union(spark.table(pending))
        days = materialize(days.distinct(), pending)
    for name, compute in daily.items():
        if whole:
            build_daily(compute(silver), names[name], _DAY)
        else:
            rebuild_days(silver, days, created, compute, names[name], _DAY)
    derived = {
        "silver_posting_tags": posting_tags(silver),
        "dim_company": dim_company(silver),
        "fct_postings": fct_postings(silver),
        "fct_salary_mentions": salary_mentions(silver),
    }
    for name, df in derived.items():
        materialize(df, names[name], buckets=buckets if name == "silver_posting_tags" else None)
    materialize(taxonomy, skill_name)
    observe_run(silver, names["snp_postings"], run_ts, buckets)
    publish(spark, silver_name, version, silver.columns)
    materialize(silver.select(created.alias(_DAY)).where(F.lit(False)), pending)
    return {short: spark.table(name) for short, name in names.items()}


def verify(
    spark: SparkSession, source: str | None = None, bronze: DataFrame | None = None, names: Mapping[str, str] = TABLES
) -> int:
    """G13 (action): checks the written tables; 0 passed, 1 failed, 2 missing.

    ``bronze`` adds the rule on the log itself: rows that staging leaves out
    because nobody can read their time fail the gate.
    """
    rules = table_rules(source)
    tables = warehouse_tables(spark, {name: names[name] for name in rules})
    if tables is None:
        return gate(None)
    report = quality_report(tables, rules)
    if bronze is not None:
        report = report.unionByName(check(bronze, bronze_rules(), "bronze."))
    return gate(report)


def run(
    spark: SparkSession,
    bronze: DataFrame,
    seed: DataFrame,
    run_ts: datetime,
    source: str | None = None,
    buckets: int | None = None,
    names: Mapping[str, str] = TABLES,
    full: bool = False,
) -> int:
    """Action: builds every table in order, then returns the gate's verdict."""
    build(spark, bronze, seed, run_ts, buckets, names, full)
    return verify(spark, source, bronze, names)
