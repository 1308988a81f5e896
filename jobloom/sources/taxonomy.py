"""The skill taxonomy: a CSV seed, or the built-in one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SEED_SCHEMA = "canonical STRING, aliases STRING"

# Canonical skill and its aliases, separated by pipes.
SKILLS = (
    ("python", "python|py"),
    ("sql", "sql|t-sql|ansi sql"),
    ("dbt", "dbt|dbt-core"),
    ("airflow", "airflow|apache airflow"),
    ("dagster", "dagster"),
    ("spark", "spark|apache spark|pyspark"),
    ("kafka", "kafka|apache kafka|redpanda"),
    ("snowflake", "snowflake"),
    ("bigquery", "bigquery|gbq|google bigquery"),
    ("databricks", "databricks"),
    ("aws", "aws|amazon web services"),
    ("gcp", "gcp|google cloud|google cloud platform"),
    ("azure", "azure|microsoft azure"),
    ("docker", "docker"),
    ("kubernetes", "kubernetes|k8s"),
    ("terraform", "terraform"),
    ("go", "golang|go"),
    ("java", "java"),
    ("scala", "scala"),
    ("typescript", "typescript|ts"),
    ("react", "react|reactjs"),
    ("postgres", "postgres|postgresql"),
    ("mongodb", "mongodb|mongo"),
    ("redis", "redis"),
    ("elasticsearch", "elasticsearch|elastic"),
    ("tableau", "tableau"),
    ("looker", "looker"),
    ("powerbi", "powerbi|power bi"),
    ("fivetran", "fivetran"),
    ("dlt", "dlt|data load tool"),
    ("iceberg", "iceberg|apache iceberg"),
    ("delta", "delta|delta lake"),
    ("hadoop", "hadoop"),
    ("flink", "flink|apache flink"),
    ("beam", "apache beam|beam"),
)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with the header ``canonical,aliases``."""
    return spark.read.schema(SEED_SCHEMA).option("header", True).csv(path)


def default_seed(spark: SparkSession) -> DataFrame:
    """The built-in taxonomy in the same shape.

    As SQL values the planner knows its size, so tags are never shuffled to meet it.
    """
    values = ", ".join(f"('{canonical}', '{aliases}')" for canonical, aliases in SKILLS)
    return spark.sql(f"SELECT * FROM VALUES {values} AS seed(canonical, aliases)")
