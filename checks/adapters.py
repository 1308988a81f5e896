"""Posting-shaped views of the driver tables (FIXTURES.md 3).

The text is plain SQL that Spark and DuckDB read alike.  ``{events}`` and so on
stand for the input, a DataFrame in Spark and a view name in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.functions.text import epoch_to_timestamp

# Parsed log at staging grain; a null title stands for a failed contract.
POST = """
SELECT event_id,
  CASE WHEN event_id % 10 = 9 THEN 'board_b' ELSE 'board_a' END AS source,
  concat('p', CAST(user_id AS STRING)) AS source_id,
  concat('p', CAST(user_id AS STRING)) AS slug,
  concat('https://jobs.example.com/p', CAST(user_id AS STRING)) AS url,
  ts AS ingested_at,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat('Role ', event_type) END AS title,
  CASE WHEN user_id % 17 = 0 THEN NULL ELSE concat('Company ', CAST(user_id % 40 AS STRING)) END AS company_name,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE value > 20 END AS remote,
  CASE event_id % 12 WHEN 0 THEN 'Berlin, Germany' WHEN 1 THEN 'MÜNCHEN' WHEN 2 THEN 'Hamburg'
    WHEN 3 THEN 'Frankfurt am Main' WHEN 4 THEN 'Köln' WHEN 5 THEN 'Wien, Austria' WHEN 6 THEN 'Zürich'
    WHEN 7 THEN 'Remote' WHEN 8 THEN '  ' WHEN 9 THEN 'Wien, Germany' WHEN 10 THEN 'Basel, Switzerland'
    ELSE NULL END AS location,
  CASE event_id % 8 WHEN 0 THEN '["Python","sql"]' WHEN 1 THEN '["py","python"]' WHEN 2 THEN '[]' WHEN 3 THEN NULL
    WHEN 4 THEN '["Apache Spark","k8s","go"]' WHEN 5 THEN '["unknown",""]' WHEN 6 THEN '["gbq",null]'
    ELSE '["pyspark","Spark","aws"]' END AS tags_json,
  CASE event_id % 6 WHEN 0 THEN concat('Pay ', CAST(15000 + (event_id % 50) * 3000 AS STRING), ' EUR')
    WHEN 1 THEN '50.000 - 60.000 €' WHEN 2 THEN '€50,000 – €60,000' WHEN 3 THEN '65000 europe' WHEN 4 THEN ''
    ELSE NULL END AS description,
  1704067200 + user_id * 7200 AS created_at_epoch
FROM {events}
"""

# Posting payload as JSON text.
RAW = """
SELECT event_id, source, source_id, ingested_at,
  '{{"slug":"' || slug || '","company_name":' || coalesce('"' || company_name || '"', 'null')
  || coalesce(',"title":"' || title || '"', '') || ',"url":"' || url || '"'
  || coalesce(',"tags":' || tags_json, '') || coalesce(',"location":"' || location || '"', '')
  || ',"remote":' || CASE WHEN remote THEN 'true' ELSE 'false' END
  || ',"created_at":' || CAST(created_at_epoch AS STRING) || '}}' AS payload
FROM {post}
"""

# Message values, some of them no JSON and some no object.
MSG = """
SELECT event_id, ingested_at AS sent_at, CASE WHEN event_id % 29 = 0 THEN 'not json' WHEN event_id % 31 = 0 THEN '[1]'
  ELSE concat('{{"source":"', source, '","source_id":"', source_id,
    '","ingested_at":"2024-01-01T00:00:00Z","source_payload":', payload,
    CASE WHEN event_id % 13 = 0 THEN ',"typed":null}}' ELSE concat(',"typed":', payload, '}}') END) END AS value
FROM {raw}
"""

# Tables in which every quality rule finds something; {t} stands for the sound table.
SPOILT = {
    "silver_postings": """
SELECT CASE WHEN k % 5 = 0 THEN NULL ELSE source END AS source, CASE WHEN k % 5 = 1 THEN NULL ELSE source_id END AS source_id,
  CASE WHEN k % 5 = 2 THEN NULL ELSE title END AS title, CASE WHEN k % 5 = 3 THEN NULL ELSE last_seen_at END AS last_seen_at,
  CASE WHEN k % 3 = 0 THEN 'FR' ELSE country_code END AS country_code, k
FROM (SELECT *, CAST(substr(source_id, 2) AS INT) AS k FROM {t} UNION ALL SELECT *, CAST(substr(source_id, 2) AS INT) FROM {t}) twice""",
    "silver_posting_tags": """
SELECT CASE WHEN k % 3 = 0 THEN NULL ELSE source END AS source, CASE WHEN k % 3 = 1 THEN NULL ELSE source_id END AS source_id,
  CASE WHEN k % 3 = 2 THEN NULL ELSE tag END AS tag FROM (SELECT *, CAST(substr(source_id, 2) AS INT) AS k FROM {t}) numbered""",
    "fct_postings": """
SELECT CASE WHEN k % 4 = 0 THEN NULL ELSE posting_id END AS posting_id, CASE WHEN k % 4 = 1 THEN NULL ELSE title END AS title,
  CASE WHEN k % 4 = 2 THEN NULL ELSE last_seen_at END AS last_seen_at, CASE WHEN k % 3 = 0 THEN 'FR' ELSE country_code END AS country_code
FROM (SELECT *, CAST(substr(posting_id, 2) AS INT) AS k FROM {t} UNION ALL SELECT *, CAST(substr(posting_id, 2) AS INT) FROM {t}) twice""",
    "dim_company": """
SELECT CASE WHEN posting_count % 2 = 0 THEN NULL ELSE company_name END AS company_name,
  CASE WHEN length(company_name) % 2 = 0 THEN 0 ELSE posting_count END AS posting_count
FROM (SELECT * FROM {t} UNION ALL SELECT * FROM {t}) twice""",
    "dim_skill": """
SELECT CASE WHEN length(alias) % 2 = 0 THEN NULL ELSE skill END AS skill, CASE WHEN length(alias) % 3 = 0 THEN NULL ELSE alias END AS alias FROM {t}""",
    "fct_skill_demand_daily": """
SELECT CASE WHEN length(skill) % 3 = 0 THEN NULL ELSE posting_date END AS posting_date, CASE WHEN length(skill) % 2 = 0 THEN NULL ELSE skill END AS skill,
  country_code, CASE WHEN country_code = 'AT' THEN NULL ELSE posting_count - 1 END AS posting_count, remote_posting_count, 'x' AS extra FROM {t}""",
    "fct_remote_policy_daily": """
SELECT CASE WHEN country_code = 'DE' THEN NULL ELSE posting_date END AS posting_date, CASE WHEN country_code = 'AT' THEN NULL ELSE country_code END AS country_code,
  remote_share + 0.5 AS remote_share FROM {t}""",
    "fct_salary_mentions": """
SELECT CASE WHEN salary_eur % 2000 = 0 THEN NULL ELSE source_id END AS source_id, salary_eur * 6 AS salary_eur FROM {t}""",
}

# Message values whose typed record has all of a posting, at the time of its event.
POST_MSG = """
SELECT event_id, source, ingested_at, concat('{{"source":"', source, '","source_id":"', source_id, '","ingested_at":"',
  replace(CAST(ingested_at AS STRING), ' ', 'T'), 'Z","source_payload":{{}},"typed":{{"slug":"', slug, '","url":"', url,
  '","title":"', title, '"', coalesce(',"company_name":"' || company_name || '"', ''),
  coalesce(',"description":"' || description || '"', ''), coalesce(',"location":"' || location || '"', ''),
  coalesce(',"tags":' || tags_json, ''), ',"remote":', coalesce(CAST(remote AS STRING), 'null'),
  ',"job_types":["full-time"],"created_at":', CAST(created_at_epoch AS STRING), '}}}}') AS value
FROM {post} WHERE title IS NOT NULL
"""

# Page payloads of 25 postings each over the whole log, then an empty page and one beyond it.
JOB_PAGES = """
SELECT CAST(p AS INT) AS page, concat('{{"data":[', string_agg(payload, ','), ']}}') AS payload
FROM (SELECT floor(event_id / 25) + 1 AS p, payload FROM {raw}) numbered GROUP BY p
UNION ALL
SELECT CAST(max(floor(event_id / 25)) + 2 AS INT), '{{"data":[]}}' FROM {raw}
UNION ALL
SELECT CAST(max(floor(event_id / 25)) + 3 AS INT), '{{"data":[{{"slug":"never"}}]}}' FROM {raw}
"""

# A taxonomy of catalogue words: each brand with its part names and types as aliases.
CATALOGUE = """
SELECT p_brand AS canonical, concat(p_name, '|', p_type, '| ', upper(p_name), '||') AS aliases FROM {part}
"""

# A second board: orders as postings, without location and tags.
ORDER_BOARD = """
SELECT 'board_c' AS source, concat('o', CAST(o_orderkey AS STRING)) AS posting_id,
  concat('Role ', o_orderpriority) AS title, concat('Customer ', CAST(o_custkey AS STRING)) AS company_name,
  o_orderstatus = 'F' AS remote, o_orderdate AS posting_created_at
FROM {orders}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def post(spark: SparkSession, events: DataFrame) -> DataFrame:
    return spark.sql(POST, events=events)


def raw(spark: SparkSession, events: DataFrame) -> DataFrame:
    return spark.sql(RAW, post=post(spark, events))


def messages(spark: SparkSession, events: DataFrame) -> DataFrame:
    return spark.sql(MSG, raw=raw(spark, events))


def post_messages(spark: SparkSession, events: DataFrame) -> DataFrame:
    return spark.sql(POST_MSG, post=post(spark, events))


def job_pages(spark: SparkSession, events: DataFrame) -> DataFrame:
    return spark.sql(JOB_PAGES, raw=raw(spark, events))


def staged(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The log at the grain of the staging view, with ``event_id`` to break ties."""
    return (
        post(spark, events)
        .where(F.col("title").isNotNull())
        .withColumns(
            {
                "job_types_json": F.lit('["full-time"]'),
                "posting_created_at": epoch_to_timestamp(F.col("created_at_epoch")),
            }
        )
    )
