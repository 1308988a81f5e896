"""Quality rules, their report and the gate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobloom.functions.text import iso_to_timestamp
from jobloom.schemas import FCT_POSTINGS, FCT_SKILL_DEMAND_DAILY, SILVER_POSTINGS


@dataclass(frozen=True)
class Rule:
    """One rule of a table; the functions below build the kinds."""

    name: str
    kind: str
    column: str | None = None
    broken: Column | None = field(default=None, compare=False)
    where: Column | None = field(default=None, compare=False)
    schema: StructType | None = None


def not_null(*columns: str) -> list[Rule]:
    """No row without a value."""
    return [Rule(f"{c}.not_null", "row", c, F.col(c).isNull()) for c in columns]


def unique(column: str, where: Column | None = None) -> Rule:
    """No value twice; nulls do not count.  Failures are repeated values."""
    return Rule(f"{column}.unique", "unique", column, where=where)


def accepted(column: str, values: Iterable[Any]) -> Rule:
    """Every value is one of ``values``; nulls pass."""
    return Rule(f"{column}.accepted", "row", column, ~F.col(column).isin(*values))


def in_range(column: str, lo: float | None = None, hi: float | None = None) -> Rule:
    """Bounds are inclusive; nulls pass."""
    bounds = []
    if lo is not None:
        bounds.append(F.col(column) < lo)
    if hi is not None:
        bounds.append(F.col(column) > hi)
    return Rule(f"{column}.range", "row", column, reduce(lambda a, b: a | b, bounds))


def at_least(larger: str, smaller: str) -> Rule:
    """One column never below another; a null on either side passes."""
    return Rule(f"{larger}.at_least.{smaller}", "row", larger, F.col(larger) < F.col(smaller))


def contract(schema: StructType) -> Rule:
    """Exactly these columns, in this order, of these types."""
    return Rule("contract", "schema", schema=schema)


def schema_mismatches(df: DataFrame, schema: StructType) -> int:
    """Number of columns that are missing, unexpected, misplaced or of another type."""
    actual = [(f.name, f.dataType) for f in df.schema]
    wanted = [(f.name, f.dataType) for f in schema]
    same = sum(a == w for a, w in zip(actual, wanted, strict=False))
    return max(len(actual), len(wanted)) - same


def _repeated_values(df: DataFrame, rule: Rule) -> DataFrame:
    rows = df if rule.where is None else df.where(rule.where)
    return (
        rows.where(F.col(rule.column).isNotNull())
        .groupBy(rule.column)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.count_if(F.col("_n") > 1).alias("failed_rows"))
        .select(F.lit(rule.name).alias("rule"), "failed_rows")
    )


def check(df: DataFrame, rules: Sequence[Rule], prefix: str = "") -> DataFrame:
    """One row per rule: ``rule``, ``failed_rows``, ``passed``.

    All row rules share a single aggregate over the table; each uniqueness rule
    adds one grouping.  Contracts need no data.
    """
    row_rules = [r for r in rules if r.kind == "row"]
    counted = {f"_{i}": F.count_if(r.broken) for i, r in enumerate(row_rules)}
    counted |= {
        f"s{i}": F.lit(schema_mismatches(df, r.schema)).cast("bigint")
        for i, r in enumerate(x for x in rules if x.kind == "schema")
    }
    names = [r.name for r in row_rules] + [r.name for r in rules if r.kind == "schema"]
    parts = []
    if counted:
        totals = df.agg(*[c.alias(k) for k, c in counted.items()])
        lines = [
            F.struct(F.lit(n).alias("rule"), F.col(k).alias("failed_rows")) for n, k in zip(names, counted, strict=True)
        ]
        parts.append(totals.select(F.inline(F.array(*lines))))
    parts += [_repeated_values(df, r) for r in rules if r.kind == "unique"]
    report = reduce(DataFrame.unionByName, parts)
    return report.select(
        F.concat(F.lit(prefix), "rule").alias("rule"), "failed_rows", (F.col("failed_rows") == 0).alias("passed")
    )


# The countries a posting can have, and plausible salaries in EUR.
ACCEPTED_COUNTRIES = ("DE", "AT", "CH")
SALARY_RANGE = (20_000, 400_000)


def bronze_rules() -> list[Rule]:
    """Rows whose ingestion time staging cannot read."""
    return [Rule("ingested_at.readable", "row", "ingested_at", iso_to_timestamp(F.col("ingested_at")).isNull())]


def table_rules(source: str | None = None) -> dict[str, list[Rule]]:
    """The rules of every table.

    ``source`` limits the uniqueness of silver ids to one source (G7); without it
    ids must be unique over all sources.
    """
    one_source = None if source is None else F.col("source") == source
    return {
        "silver_postings": [
            contract(SILVER_POSTINGS),
            *not_null("source", "source_id", "title", "last_seen_at"),
            unique("source_id", where=one_source),
            accepted("country_code", ACCEPTED_COUNTRIES),
        ],
        "silver_posting_tags": not_null("source", "source_id", "tag"),
        "fct_postings": [
            contract(FCT_POSTINGS),
            *not_null("posting_id", "title", "last_seen_at"),
            unique("posting_id"),
            accepted("country_code", ACCEPTED_COUNTRIES),
        ],
        "dim_company": [*not_null("company_name"), unique("company_name"), in_range("posting_count", lo=1)],
        "dim_skill": not_null("skill", "alias"),
        "fct_skill_demand_daily": [
            contract(FCT_SKILL_DEMAND_DAILY),
            *not_null("posting_date", "skill", "posting_count"),
            in_range("posting_count", lo=1),
            at_least("posting_count", "remote_posting_count"),
        ],
        "fct_remote_policy_daily": [*not_null("posting_date", "country_code"), in_range("remote_share", 0, 1)],
        "fct_salary_mentions": [*not_null("source_id"), in_range("salary_eur", *SALARY_RANGE)],
    }


def quality_report(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]] | None = None) -> DataFrame:
    """The reports of all given tables as one, rule names prefixed by the table."""
    rules = table_rules() if rules is None else rules
    return reduce(DataFrame.unionByName, [check(df, rules[name], f"{name}.") for name, df in tables.items()])


def gate(report: DataFrame | None) -> int:
    """G13 (action): 0 when every rule passed, 1 after listing failures, 2 without a warehouse.

    The report has one row per rule, so what comes to the driver is bounded by
    the number of rules.
    """
    if report is None:
        print("quality gate: the warehouse is missing")
        return 2
    failures = report.where(~F.col("passed")).orderBy("rule").collect()
    for row in failures:
        print(f"quality gate: {row['rule']} failed on {row['failed_rows']}")
    return 1 if failures else 0


def warehouse_tables(spark: SparkSession, names: Mapping[str, str]) -> dict[str, DataFrame] | None:
    """The named tables, or None when one of them does not exist."""
    if not all(spark.catalog.tableExists(n) for n in names.values()):
        return None
    return {short: spark.table(n) for short, n in names.items()}
