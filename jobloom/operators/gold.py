"""Gold facts and dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.functions.text import (
    day_of,
    extract_salary,
    normalize_alias,
    or_unknown,
    parse_salary,
    salary_band,
    share,
)
from jobloom.schemas import POSTING_KEY

from .postings import tag_list

COUNTRIES = ("DE", "AT", "CH")


def fct_postings(silver: DataFrame) -> DataFrame:
    """One row per posting with the day of its creation."""
    return silver.select(
        F.col("source_id").alias("posting_id"),
        "title",
        "company_name",
        F.col("city_normalized").alias("city"),
        "country_code",
        "remote",
        "url",
        "posting_created_at",
        "last_seen_at",
        day_of(F.col("posting_created_at")).alias("posting_created_date"),
    )


def dim_skill(seed: DataFrame) -> DataFrame:
    """Distinct (skill, alias) pairs of a taxonomy."""
    pieces = F.explode(F.split("aliases", r"[|]"))
    return (
        seed.select(F.col("canonical").alias("skill"), pieces.alias("_piece"))
        .select("skill", normalize_alias(F.col("_piece")).alias("alias"))
        .distinct()
    )


def dim_company(silver: DataFrame, countries: Sequence[str] = COUNTRIES) -> DataFrame:
    """Posting counts and first and last sight per company."""
    per_country = [
        F.count_if(F.col("country_code") == code).alias(f"{code.lower()}_posting_count") for code in countries
    ]
    return (
        silver.where(F.col("company_name").isNotNull())
        .groupBy("company_name")
        .agg(
            F.count(F.lit(1)).alias("posting_count"),
            F.count_if("remote").alias("remote_posting_count"),
            *per_country,
            F.min("posting_created_at").alias("first_seen_at"),
            F.max("last_seen_at").alias("last_seen_at"),
        )
    )


def remote_policy_daily(silver: DataFrame, unknown: str = "XX") -> DataFrame:
    """A2: remote postings per day and country.

    Grouping is by the raw code, so a missing code and a literal ``unknown`` stay
    two rows with the same label.
    """
    return (
        silver.where(F.col("posting_created_at").isNotNull())
        .groupBy(day_of(F.col("posting_created_at")).alias("posting_date"), F.col("country_code").alias("_code"))
        .agg(F.count(F.lit(1)).alias("posting_count"), F.count_if("remote").alias("remote_count"))
        .select(
            "posting_date",
            or_unknown(F.col("_code"), unknown).alias("country_code"),
            "posting_count",
            "remote_count",
            share(F.col("remote_count"), F.col("posting_count")).alias("remote_share"),
        )
    )


def salary_mentions(silver: DataFrame, lo: int = 20_000, hi: int = 400_000) -> DataFrame:
    """Postings whose description names a plausible salary.

    The amount passes through a one-item explode: filters do not move below it,
    so the pattern runs once per description instead of once per filter.
    """
    amount = parse_salary(extract_salary(F.col("description")))
    return (
        silver.select("source_id", "title", "country_code", F.explode(F.array(amount)).alias("salary_eur"))
        .where(F.col("salary_eur").between(lo, hi))
        .withColumn("salary_band", salary_band(F.col("salary_eur")))
    )


def _daily_demand(hits: DataFrame, by_source: bool) -> DataFrame:
    """A3: distinct postings per day, skill and country.

    Repeats of a posting fold first, keyed by the posting itself, so one popular
    skill is spread over many tasks; the counts then need no second distinct.
    """
    posting = POSTING_KEY if by_source else ["source_id"]
    cell = ["posting_date", "skill", "country_code"]
    counted = F.col("source_id").isNotNull()
    if by_source:
        counted = counted & F.col("source").isNotNull()
    return (
        hits.groupBy(*cell, *posting)
        .agg(F.max("remote").alias("_remote"))
        .groupBy(*cell)
        .agg(
            F.count_if(counted).alias("posting_count"),
            F.count_if(counted & F.col("_remote")).alias("remote_posting_count"),
        )
    )


def skill_demand_daily(tags: DataFrame, postings: DataFrame, skills: DataFrame, by_source: bool = False) -> DataFrame:
    """Skill demand from the tag, posting and skill tables.

    Tags meet the skills first, which leaves only known tags for the large join.
    Spark broadcasts the skills when their size allows and shuffles otherwise.
    """
    known = tags.join(skills, tags["tag"] == skills["alias"]).select(*POSTING_KEY, "skill")
    facts = postings.select(
        *POSTING_KEY, day_of(F.col("posting_created_at")).alias("posting_date"), "country_code", "remote"
    )
    return _daily_demand(known.join(facts, POSTING_KEY), by_source)


def skill_demand_of(silver: DataFrame, skills: DataFrame, by_source: bool = False) -> DataFrame:
    """The same table straight from silver, without the join of tags and postings.

    Each tag row comes from exactly one silver row, so unnesting next to the
    posting's columns replaces the large join.
    """
    tagged = silver.where(F.col("tags_json") != "[]").select(
        *POSTING_KEY,
        day_of(F.col("posting_created_at")).alias("posting_date"),
        "country_code",
        "remote",
        F.explode(F.array_distinct(tag_list(F.col("tags_json")))).alias("tag"),
    )
    return _daily_demand(tagged.join(skills, tagged["tag"] == skills["alias"]), by_source)


def blend(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; a column missing from one is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
