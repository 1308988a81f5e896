"""Read queries over the gold tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.text import share, week_of, within_days
from jobloom.operators.gold import COUNTRIES

POSTING_COLUMNS = ["posting_id", "title", "company_name", "city", "country_code", "remote", "url"]

AsOf = date | datetime | Column | None


def _within(name: str, value: int, lo: int, hi: int) -> None:
    if not lo <= value <= hi:
        raise ValueError(f"{name} must be between {lo} and {hi}")


def in_country(df: DataFrame, country: str | None) -> DataFrame:
    """Rows of one country when a country is given."""
    if country is None:
        return df
    if country not in COUNTRIES:
        raise ValueError(f"country must be one of {', '.join(COUNTRIES)}")
    return df.where(F.col("country_code") == country)


def _newest_postings_first() -> list[Column]:
    ties = ["last_seen_at", "title", "company_name", "city", "country_code", "remote", "url"]
    return [
        F.col("posting_created_at").desc_nulls_last(),
        F.col("posting_id").asc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in ties],
    ]


def list_postings(
    fct: DataFrame,
    tags: DataFrame,
    skills: DataFrame,
    country: str | None = None,
    remote: bool | None = None,
    skill: str | None = None,
    limit: int = 50,
    distinct: bool = False,
) -> DataFrame:
    """Q1 (P27, J4, O1): the newest postings that meet every given condition.

    With a skill, a posting appears once per matching tag, as in a plain join of
    postings, tags and aliases by posting id; ``distinct`` lists it once.  The
    tags are counted per posting before the join, and only the first ``limit``
    postings are repeated, which cannot change the first ``limit`` rows.
    """
    _within("limit", limit, 1, 500)
    rows = in_country(fct, country)
    if remote is not None:
        rows = rows.where(F.col("remote") == remote)
    order = _newest_postings_first()
    if skill:
        aliases = skills.where(F.col("skill") == skill.lower()).select("alias")
        hits = (
            tags.join(aliases, tags["tag"] == aliases["alias"])
            .groupBy(F.col("source_id").alias("posting_id"))
            .agg(F.count(F.lit(1)).alias("_matches"))
        )
        rows = rows.join(hits, "posting_id")
        if not distinct:
            copies = F.least(F.col("_matches"), F.lit(limit)).cast("int")
            rows = rows.orderBy(*order).limit(limit).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return rows.orderBy(*order).limit(limit).select(*POSTING_COLUMNS)


def top_skills(
    demand: DataFrame, as_of: AsOf = None, days: int = 30, country: str | None = None, limit: int = 20
) -> DataFrame:
    """Q2 (P25, P28, A11, O2): the largest (day, skill, country) cells of the last days."""
    _within("days", days, 1, 365)
    _within("limit", limit, 1, 200)
    return (
        in_country(demand.where(within_days(F.col("posting_date"), days, as_of)), country)
        .groupBy(F.col("posting_date").cast("string").alias("posting_date"), "skill", "country_code")
        .agg(F.sum("posting_count").cast("int").alias("posting_count"))
        .orderBy(
            F.col("posting_count").desc_nulls_last(),
            *[F.col(c).asc_nulls_last() for c in ("posting_date", "skill", "country_code")],
        )
        .limit(limit)
    )


def totals(fct: DataFrame) -> DataFrame:
    """Q3 (A6): postings, remote postings, companies and countries, in one row.

    Rows fold per company and country first, so the distinct counts run over
    that much smaller set.
    """
    return (
        fct.groupBy("company_name", "country_code")
        .agg(F.count(F.lit(1)).alias("_n"), F.count_if("remote").alias("_remote"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("postings"),
            F.coalesce(F.sum("_remote"), F.lit(0).cast("bigint")).alias("remote_count"),
            F.count_distinct("company_name").alias("companies"),
            F.count_distinct("country_code").alias("countries"),
        )
    )


def top_skills_total(demand: DataFrame, as_of: AsOf = None, days: int = 30, limit: int = 20) -> DataFrame:
    """Q4 (A7, O3): skills by postings over the last days."""
    return (
        demand.where(within_days(F.col("posting_date"), days, as_of))
        .groupBy("skill")
        .agg(F.sum("posting_count").alias("postings"))
        .orderBy(F.col("postings").desc_nulls_last(), F.col("skill").asc_nulls_last())
        .limit(limit)
    )


def weekly_remote_share(remote: DataFrame, countries: Sequence[str] = COUNTRIES, pivot: bool = False) -> DataFrame:
    """Q5 (P22, P26, A9, A10, O5): remote share per week and country, a ratio of sums."""
    weekly = (
        remote.where(F.col("country_code").isin(*countries))
        .groupBy(week_of(F.col("posting_date")).alias("week"), "country_code")
        .agg(share(F.sum("remote_count"), F.sum("posting_count")).alias("remote_share"))
    )
    if pivot:
        wide = weekly.groupBy("week").pivot("country_code", list(countries)).agg(F.first("remote_share"))
        return wide.orderBy(F.col("week").asc_nulls_last())
    return weekly.orderBy(F.col("week").asc_nulls_last(), F.col("country_code").asc_nulls_last())


def skill_names(demand: DataFrame) -> DataFrame:
    """Q6 (A5): the skills in demand, sorted."""
    return demand.select("skill").distinct().orderBy(F.col("skill").asc_nulls_last())


def skill_series(
    demand: DataFrame, skills: Sequence[str] | None = None, country: str | None = None, preselected: int = 6
) -> DataFrame:
    """Q6 (A8, P26, P27, O5): postings per day for the chosen skills.

    Without a choice the first ``preselected`` skill names are taken, as a selection starts.
    """
    rows = in_country(demand, country)
    if skills is None:
        rows = rows.join(skill_names(demand).limit(preselected), "skill", "left_semi")
    elif not skills:
        raise ValueError("choose at least one skill")
    else:
        rows = rows.where(F.col("skill").isin(*skills))
    return (
        rows.groupBy("posting_date", "skill")
        .agg(F.sum("posting_count").alias("postings"))
        .orderBy(F.col("posting_date").asc_nulls_last(), F.col("skill").asc_nulls_last())
    )


def top_companies(companies: DataFrame, limit: int = 100) -> DataFrame:
    """Q7 (O4): the companies with most postings."""
    per_country = [f"{c.lower()}_posting_count" for c in COUNTRIES]
    return (
        companies.select("company_name", "posting_count", "remote_posting_count", *per_country, "last_seen_at")
        .orderBy(F.col("posting_count").desc_nulls_last(), F.col("company_name").asc_nulls_last())
        .limit(limit)
    )
