"""DuckDB SQL that each query in ``checks.registry`` is compared with."""

from __future__ import annotations

from checks import adapters
from checks.registry import BUILT_COLUMNS
from jobloom.sources.taxonomy import SKILLS

CHECKED = ("title", "company_name", "remote", "location")


def _values(rows: tuple[tuple[str, str], ...]) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in rows)


# Every spelling of a city and of a country in lower case, in the order in which they are tried.
CITY_SPELLINGS = (
    ("berlin", "Berlin"),
    ("munich", "Munich"),
    ("münchen", "Munich"),
    ("hamburg", "Hamburg"),
    ("frankfurt", "Frankfurt"),
    ("cologne", "Cologne"),
    ("köln", "Cologne"),
    ("vienna", "Vienna"),
    ("wien", "Vienna"),
    ("zurich", "Zurich"),
    ("zürich", "Zurich"),
)
COUNTRY_SPELLINGS = (
    ("germany", "DE"),
    ("berlin", "DE"),
    ("munich", "DE"),
    ("münchen", "DE"),
    ("hamburg", "DE"),
    ("frankfurt", "DE"),
    ("cologne", "DE"),
    ("köln", "DE"),
    ("austria", "AT"),
    ("vienna", "AT"),
    ("wien", "AT"),
    ("switzerland", "CH"),
    ("zurich", "CH"),
    ("zürich", "CH"),
)


def _first_spelling(place: str, spellings: tuple[tuple[str, str], ...], other: str = "NULL") -> str:
    cases = " ".join(f"WHEN {place} LIKE '%{text}%' THEN '{value}'" for text, value in spellings)
    return f"CASE {cases} ELSE {other} END"


def _city(place: str, location: str) -> str:
    return _first_spelling(place, CITY_SPELLINGS, f"nullif(trim({location}), '')")


def _country(place: str) -> str:
    return _first_spelling(place, COUNTRY_SPELLINGS)


# Common table expressions by name; each may use the ones above it.
CTES = {
    "post": adapters.POST.format(events="events"),
    "raw": adapters.RAW.format(post="post"),
    "msg": adapters.MSG.format(raw="raw"),
    "parsed": """
        SELECT sent_at, try_cast(value AS JSON) AS j FROM msg""",
    "own": """
        SELECT sent_at, j FROM parsed WHERE json_type(j) = 'OBJECT' AND j->>'source' = 'board_a'""",
    "log": """
        SELECT *, make_timestamp(created_at_epoch * 1000000) AS posting_created_at
        FROM post WHERE title IS NOT NULL""",
    "located": """
        SELECT *, lower(location) AS place FROM (
          SELECT DISTINCT ON (source, source_id) * FROM log
          ORDER BY source, source_id, ingested_at DESC, posting_created_at DESC, event_id DESC)""",
    "mid_located": """
        SELECT * FROM (
          SELECT DISTINCT ON (source, source_id) * FROM log WHERE ingested_at < TIMESTAMP '2024-01-15'
          ORDER BY source, source_id, ingested_at DESC, posting_created_at DESC, event_id DESC)""",
    "silver": f"""
        SELECT source, source_id, slug, company_name, title, description, url, location, remote, tags_json,
          '["full-time"]' AS job_types_json, posting_created_at, ingested_at AS last_seen_at,
          {_city('place', 'location')} AS city_normalized, {_country('place')} AS country_code
        FROM located""",
    "fct": """
        SELECT source_id AS posting_id, title, company_name, city_normalized AS city, country_code, remote, url,
          posting_created_at, last_seen_at, CAST(date_trunc('day', posting_created_at) AS TIMESTAMP) AS posting_created_date
        FROM silver""",
    "tags": """
        SELECT source, source_id, last_seen_at, lower(trim(tag, '"')) AS tag
        FROM (SELECT source, source_id, last_seen_at, unnest(CAST(CAST(tags_json AS JSON) AS VARCHAR[])) AS tag FROM silver)
        WHERE tag IS NOT NULL""",
    "skills": f"""
        SELECT DISTINCT skill, lower(trim(alias)) AS alias
        FROM (SELECT skill, unnest(string_split(aliases, '|')) AS alias FROM (VALUES {_values(SKILLS)}) seed(skill, aliases))""",
    "demand": """
        SELECT CAST(date_trunc('day', posting_created_at) AS TIMESTAMP) AS posting_date, skill, country_code,
          count(DISTINCT tags.source_id) AS posting_count,
          count(DISTINCT CASE WHEN remote THEN tags.source_id END) AS remote_posting_count
        FROM tags JOIN skills ON tag = alias
        JOIN silver ON silver.source = tags.source AND silver.source_id = tags.source_id GROUP BY ALL""",
    "companies": """
        SELECT company_name, count(*) AS posting_count, count(*) FILTER (remote) AS remote_posting_count,
          count(*) FILTER (country_code = 'DE') AS de_posting_count, count(*) FILTER (country_code = 'AT') AS at_posting_count,
          count(*) FILTER (country_code = 'CH') AS ch_posting_count,
          min(posting_created_at) AS first_seen_at, max(last_seen_at) AS last_seen_at
        FROM silver WHERE company_name IS NOT NULL GROUP BY company_name""",
    "remote_daily": """
        SELECT posting_date, coalesce(code, 'XX') AS country_code, posting_count, remote_count,
          remote_count / CAST(posting_count AS DOUBLE) AS remote_share
        FROM (SELECT CAST(date_trunc('day', posting_created_at) AS TIMESTAMP) AS posting_date, country_code AS code,
                count(*) AS posting_count, count(*) FILTER (remote) AS remote_count
              FROM silver WHERE posting_created_at IS NOT NULL GROUP BY ALL)""",
    "salaries": r"""
        SELECT source_id, title, country_code, salary_eur,
          CASE WHEN salary_eur >= 130000 THEN '130k+' WHEN salary_eur >= 100000 THEN '100-130k'
            WHEN salary_eur >= 80000 THEN '80-100k' WHEN salary_eur >= 60000 THEN '60-80k'
            WHEN salary_eur >= 40000 THEN '40-60k' ELSE '<40k' END AS salary_band
        FROM (SELECT source_id, title, country_code, try_cast(translate(
                regexp_extract(description, '(\d{2,3}[\.,]?\d{3})\s*(?:€|EUR|euro)', 1), '.,', '') AS INTEGER) AS salary_eur
              FROM silver)
        WHERE salary_eur BETWEEN 20000 AND 400000""",
    "observed": """
        SELECT source, source_id, slug, title, company_name, remote, location, ingested_at AS snapshot_observed_at, event_id
        FROM log""",
    "history": """
        SELECT source, source_id, slug, title, company_name, remote, location, snapshot_observed_at, event_id,
          snapshot_observed_at AS valid_from,
          lead(snapshot_observed_at) OVER (PARTITION BY source, source_id ORDER BY snapshot_observed_at, event_id) AS valid_to
        FROM (SELECT *, row(title, company_name, remote, location) AS state,
                lag(row(title, company_name, remote, location)) OVER w AS before, row_number() OVER w AS n FROM observed
              WINDOW w AS (PARTITION BY source, source_id ORDER BY snapshot_observed_at, event_id))
        WHERE n = 1 OR state IS DISTINCT FROM before""",
    # The history after a run over the postings of mid-month and one over those of now.
    "two_runs": """
        WITH first_run AS (
          SELECT source, source_id, slug, title, company_name, remote, location, ingested_at AS snapshot_observed_at FROM mid_located),
        changed AS (
          SELECT s.source, s.source_id FROM silver s LEFT JOIN first_run p ON p.source = s.source AND p.source_id = s.source_id
          WHERE p.source IS NULL OR row(p.title, p.company_name, p.remote, p.location)
            IS DISTINCT FROM row(s.title, s.company_name, s.remote, s.location))
        SELECT p.*, TIMESTAMP '2024-01-15' AS valid_from, CASE WHEN EXISTS (SELECT 1 FROM changed c
            WHERE c.source = p.source AND c.source_id = p.source_id) THEN TIMESTAMP '2024-02-01' END AS valid_to
        FROM first_run p
        UNION ALL
        SELECT source, source_id, slug, title, company_name, remote, location, last_seen_at, TIMESTAMP '2024-02-01', NULL
        FROM silver JOIN changed USING (source, source_id)""",
    "first_board_runs": """
        WITH first_run AS (
          SELECT source, source_id, slug, title, company_name, remote, location, ingested_at AS snapshot_observed_at FROM mid_located WHERE source = 'board_a'),
        changed AS (
          SELECT s.source, s.source_id FROM silver s LEFT JOIN first_run p ON p.source = s.source AND p.source_id = s.source_id
          WHERE p.source IS NULL OR row(p.title, p.company_name, p.remote, p.location)
            IS DISTINCT FROM row(s.title, s.company_name, s.remote, s.location))
        SELECT p.*, TIMESTAMP '2024-01-15' AS valid_from, CASE WHEN EXISTS (SELECT 1 FROM changed c
            WHERE c.source = p.source AND c.source_id = p.source_id) THEN TIMESTAMP '2024-02-01' END AS valid_to
        FROM first_run p
        UNION ALL
        SELECT source, source_id, slug, title, company_name, remote, location, last_seen_at, TIMESTAMP '2024-02-01', NULL
        FROM silver JOIN changed USING (source, source_id)""",
    "catalogue_skills": f"""
        SELECT DISTINCT canonical AS skill, lower(trim(alias)) AS alias
        FROM (SELECT canonical, unnest(string_split(aliases, '|')) AS alias
              FROM ({adapters.CATALOGUE.format(part="part")}))""",
}

CTES |= {f"spoilt_{cte}": adapters.SPOILT[t].format(t=cte) for t, cte in (
    ("silver_postings", "silver"), ("silver_posting_tags", "tags"), ("fct_postings", "fct"), ("dim_company", "companies"),
    ("dim_skill", "catalogue_skills"), ("fct_skill_demand_daily", "demand"), ("fct_remote_policy_daily", "remote_daily"),
    ("fct_salary_mentions", "salaries"),
)}

# What each expression reads, so that a query carries only what it needs.
USES = {
    "raw": ["post"],
    "msg": ["raw"],
    "parsed": ["msg"],
    "own": ["parsed"],
    "log": ["post"],
    "located": ["log"],
    "mid_located": ["log"],
    "two_runs": ["mid_located", "silver"],
    "first_board_runs": ["mid_located", "silver"],
    "silver": ["located"],
    "fct": ["silver"],
    "tags": ["silver"],
    "demand": ["tags", "skills", "silver"],
    "companies": ["silver"],
    "remote_daily": ["silver"],
    "salaries": ["silver"],
    "observed": ["log"],
    "history": ["observed"],
}

USES |= {name: [name.removeprefix("spoilt_")] for name in CTES if name.startswith("spoilt_")}


def _with(names: str, body: str) -> str:
    needed: set[str] = set()
    pending = names.split()
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending += USES.get(name, [])
    heads = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in CTES if n in needed)
    return f"WITH {heads}\n{body}" if heads else body


_TYPED = """
  CASE WHEN valid THEN slug END AS typed_slug, CASE WHEN valid THEN company_name END AS typed_company_name,
  CASE WHEN valid THEN title END AS typed_title, CASE WHEN valid THEN '' END AS typed_description,
  CASE WHEN valid THEN coalesce(remote, false) END AS typed_remote, CASE WHEN valid THEN url END AS typed_url,
  CASE WHEN valid THEN trim(coalesce(location, '')) END AS typed_location,
  CASE WHEN valid THEN created_at_epoch END AS typed_created_at,
  CASE WHEN valid AND tags_json IS NOT NULL
    THEN array_to_string(CAST(CAST(tags_json AS JSON) AS VARCHAR[]), ',') ELSE '' END AS typed_tags"""

_BRONZE_SUMMARY = """
  SELECT '2024-01-31' AS ingest_date, '09' AS hour, j->>'source' AS source, j->>'source_id' AS source_id,
    count(*) AS row_count, count(*) FILTER (json_type(j->'typed') = 'OBJECT') AS typed_count,
    min(j->'source_payload'->>'url') AS url
  FROM own GROUP BY ALL"""

_LANDED = """
  SELECT 'board_a' AS source, source_id, '2024-01-31T00:00:00.000000Z' AS ingested_at"""

_COUNTRY_OF_POST = _country("lower(location)")

_NEWEST_FIRST = """ORDER BY posting_created_at DESC NULLS LAST, posting_id NULLS LAST, last_seen_at NULLS LAST,
    title NULLS LAST, company_name NULLS LAST, city NULLS LAST, country_code NULLS LAST, remote NULLS LAST, url NULLS LAST"""


def _rule(table: str, name: str, failed: str) -> str:
    return f"SELECT '{table}.{name}' AS rule, CAST(({failed}) AS BIGINT) AS n"


def _no_nulls(table: str, cte: str, *columns: str) -> list[str]:
    return [_rule(table, f"{c}.not_null", f"SELECT count(*) FROM {cte} WHERE {c} IS NULL") for c in columns]


def _broken(table: str, cte: str, name: str, condition: str) -> str:
    return _rule(table, name, f"SELECT count(*) FROM {cte} WHERE {condition}")


def _repeated(table: str, cte: str, column: str, where: str = "true") -> str:
    return _rule(
        table,
        f"{column}.unique",
        f"SELECT count(*) FROM (SELECT {column} FROM {cte} WHERE {where} AND {column} IS NOT NULL GROUP BY ALL HAVING count(*) > 1)",
    )


_UNKNOWN_COUNTRY = "country_code NOT IN ('DE', 'AT', 'CH')"
# The expression behind each table.
_CTE_OF = {
    "silver_postings": "silver",
    "silver_posting_tags": "tags",
    "fct_postings": "fct",
    "dim_company": "companies",
    "dim_skill": "catalogue_skills",
    "fct_skill_demand_daily": "demand",
    "fct_remote_policy_daily": "remote_daily",
    "fct_salary_mentions": "salaries",
}


def _quality(prefix: str = "", mismatches: tuple[int, int, int] = (0, 0, 0)) -> str:
    """Failures of every rule over the tables' expressions, their names prefixed; ``mismatches`` of the three contracts."""
    tables = ("silver_postings", "fct_postings", "fct_skill_demand_daily")
    rules = [

        *[_rule(t, "contract", f"SELECT {n}") for t, n in zip(tables, mismatches, strict=True)],
        *_no_nulls("silver_postings", f"{prefix}silver", "source", "source_id", "title", "last_seen_at"),
        _repeated("silver_postings", f"{prefix}silver", "source_id", "source = 'board_a'"),
        _broken("silver_postings", f"{prefix}silver", "country_code.accepted", _UNKNOWN_COUNTRY),
        *_no_nulls("silver_posting_tags", f"{prefix}tags", "source", "source_id", "tag"),
        *_no_nulls("fct_postings", f"{prefix}fct", "posting_id", "title", "last_seen_at"),
        _repeated("fct_postings", f"{prefix}fct", "posting_id"),
        _broken("fct_postings", f"{prefix}fct", "country_code.accepted", _UNKNOWN_COUNTRY),
        *_no_nulls("dim_company", f"{prefix}companies", "company_name"),
        _repeated("dim_company", f"{prefix}companies", "company_name"),
        _broken("dim_company", f"{prefix}companies", "posting_count.range", "posting_count < 1"),
        *_no_nulls("dim_skill", f"{prefix}catalogue_skills", "skill", "alias"),
        *_no_nulls("fct_skill_demand_daily", f"{prefix}demand", "posting_date", "skill", "posting_count"),
        _broken("fct_skill_demand_daily", f"{prefix}demand", "posting_count.range", "posting_count < 1"),
        _broken(
            "fct_skill_demand_daily", f"{prefix}demand", "posting_count.at_least.remote_posting_count",
            "posting_count < remote_posting_count",
        ),
        *_no_nulls("fct_remote_policy_daily", f"{prefix}remote_daily", "posting_date", "country_code"),
        _broken("fct_remote_policy_daily", f"{prefix}remote_daily", "remote_share.range", "remote_share NOT BETWEEN 0 AND 1"),
        *_no_nulls("fct_salary_mentions", f"{prefix}salaries", "source_id"),
        _broken("fct_salary_mentions", f"{prefix}salaries", "salary_eur.range", "salary_eur NOT BETWEEN 20000 AND 400000"),
    ]
    return " UNION ALL ".join(rules)


_SERIES = """SELECT posting_date, skill, CAST(sum(posting_count) AS BIGINT) AS postings FROM demand"""
_TOP_CELLS = """SELECT CAST(posting_date AS VARCHAR) AS posting_date, skill, country_code,
    CAST(sum(posting_count) AS INTEGER) AS posting_count FROM demand"""
_WEEKLY = """SELECT CAST(date_trunc('week', posting_date) AS TIMESTAMP) AS week, country_code,
    CAST(sum(remote_count) AS DOUBLE) / nullif(sum(posting_count), 0) AS remote_share
  FROM remote_daily WHERE country_code IN ('DE', 'AT', 'CH') GROUP BY ALL"""
_POSTING = "posting_id, title, company_name, city, country_code, remote, url"
_LINE_SIDE = "SELECT l_quantity, l_discount, l_tax, l_linestatus FROM lineitem WHERE l_returnflag"

# Every row of every built table as text.
_BUILT = " UNION ALL ".join(
    f"SELECT '{short}' AS table_name, concat_ws('|', {', '.join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)}) AS row_text FROM {cte}"
    for (short, columns), cte in zip(
        BUILT_COLUMNS.items(),
        ("silver", "tags", "first_board_runs", "skills", "companies", "fct", "demand", "remote_daily", "salaries"),
        strict=True,
    )
)

ORACLE = {
    "s1_unroll_pages": _with("raw", """
        SELECT CAST(floor(event_id / 25) AS INTEGER) + 1 AS page, CAST(payload AS JSON)->>'slug' AS slug,
          CAST(payload AS JSON)->>'title' AS title, CAST(payload AS JSON)->>'location' AS location,
          CAST(CAST(payload AS JSON)->>'created_at' AS BIGINT) AS created_at FROM raw"""),
    "s2_validate_contract": _with("post", f"""
        SELECT event_id, error AS contract_error, valid, {_TYPED}
        FROM (SELECT *, CASE WHEN company_name IS NULL AND title IS NULL THEN 'company_name,title'
                WHEN company_name IS NULL THEN 'company_name' WHEN title IS NULL THEN 'title' END AS error,
              company_name IS NOT NULL AND title IS NOT NULL AS valid FROM post)"""),
    "s3_envelope": _with("post", f"""
        {_LANDED}, company_name AS payload_company, CAST(created_at_epoch AS BIGINT) AS payload_created_at,
          company_name IS NOT NULL AND title IS NOT NULL AS is_typed FROM post"""),
    "s4_messages": _with("post", """
        SELECT source_id AS message_key, source_id, '2024-01-31T00:00:00.000000Z' AS ingested_at,
          company_name AS payload_company, CASE WHEN company_name IS NOT NULL THEN title END AS typed_title FROM post"""),
    "s5_drain_stream": _with("own", _BRONZE_SUMMARY),
    "s10_drain_metrics": _with("own", """
        SELECT (SELECT count(*) FROM own) AS written, (SELECT count(*) FROM own) AS row_count,
          (SELECT count(*) FROM parsed WHERE coalesce(json_type(j), '') <> 'OBJECT') AS bad_messages,
          (SELECT count(*) FROM parsed WHERE json_type(j) = 'OBJECT' AND j->>'source' <> 'board_a') AS other_source,
          CAST(0 AS BIGINT) AS unreadable_times"""),
    "s6_replay": _with("own", f"""
        SELECT * REPLACE (row_count * 2 AS row_count, typed_count * 2 AS typed_count) FROM ({_BRONZE_SUMMARY})"""),
    "s6_replay_window": _with("own", """
        SELECT '2024-01-31' AS ingest_date, '09' AS hour, j->>'source' AS source, j->>'source_id' AS source_id,
          CAST(sum(times) AS BIGINT) AS row_count,
          CAST(sum(CASE WHEN json_type(j->'typed') = 'OBJECT' THEN times ELSE 0 END) AS BIGINT) AS typed_count,
          min(j->'source_payload'->>'url') AS url
        FROM (SELECT j, CASE WHEN sent_at >= TIMESTAMP '2024-01-10' AND sent_at < TIMESTAMP '2024-01-13' THEN 2 ELSE 1 END AS times FROM own)
        GROUP BY ALL"""),
    "s4_published": _with("post", """
        SELECT '2024-01-31' AS ingest_date, '09' AS hour, 'board_a' AS source, source_id, count(*) AS row_count,
          count(*) FILTER (company_name IS NOT NULL AND title IS NOT NULL) AS typed_count, min(url) AS url FROM post GROUP BY ALL"""),
    "s14_dropped": _with("log", """
        SELECT ingest_date, row_count, CASE WHEN kept THEN row_count END AS kept_count, NOT kept AS dropped
        FROM (SELECT strftime(ingested_at, '%Y-%m-%d') AS ingest_date, count(*) AS row_count,
                bool_and(CAST(ingested_at AS DATE) >= DATE '2024-01-31' - 20) AS kept FROM log GROUP BY ALL)"""),
    "q8_rerun_proof": _with("fct", """
        SELECT 'rerun' AS step, CAST(0 AS BIGINT) AS parts, CAST(NULL AS VARCHAR) AS posting_id, CAST(NULL AS VARCHAR) AS title,
          CAST(NULL AS VARCHAR) AS company_name, CAST(NULL AS BIGINT) AS only_in_a, CAST(NULL AS BIGINT) AS only_in_b
        UNION ALL
        SELECT 'changed', 1, posting_id, title, company_name, n, 0 FROM (SELECT *, count(*) AS n FROM fct WHERE posting_id = 'p7' GROUP BY ALL)
        UNION ALL
        SELECT 'changed', 1, posting_id, title, company_name, 0, n
        FROM (SELECT * REPLACE ('Changed' AS title), count(*) AS n FROM fct WHERE posting_id = 'p7' GROUP BY ALL)"""),
    "s7_rederive": _with("own", """
        SELECT source_id, contract_error, count(*) AS row_count, count(*) FILTER (contract_error = 'none') AS typed_count
        FROM (SELECT j->>'source_id' AS source_id, coalesce(nullif(concat_ws(',',
                CASE WHEN (j->'source_payload'->>'company_name') IS NULL THEN 'company_name' END,
                CASE WHEN (j->'source_payload'->>'title') IS NULL THEN 'title' END), ''), 'none') AS contract_error FROM own)
        GROUP BY ALL"""),
    "s8_parse_messages": _with("parsed", """
        SELECT j->>'source' AS source, j->>'source_id' AS source_id, j->>'ingested_at' AS ingested_at,
          CAST(j->'source_payload'->>'created_at' AS BIGINT) AS payload_created_at, j->'typed'->>'title' AS typed_title,
          coalesce(json_type(j->'typed') = 'OBJECT', false) AS is_typed, j IS NULL OR json_type(j) <> 'OBJECT' AS bad,
          coalesce(json_type(j) = 'OBJECT' AND j->>'source' <> 'board_a', false) AS other_source FROM parsed"""),
    "s9_bronze_roundtrip": _with("own", f"""
        SELECT s.*, (SELECT count(*) FROM own) AS run_rows,
          (SELECT count(*) FROM parsed WHERE coalesce(json_type(j), '') <> 'OBJECT') AS run_bad,
          (SELECT count(*) FROM parsed WHERE json_type(j) = 'OBJECT' AND j->>'source' <> 'board_a') AS run_other
        FROM ({_BRONZE_SUMMARY}) s"""),
    "s14_retention": _with("log", """
        SELECT strftime(ingested_at, '%Y-%m-%d') AS ingest_date, count(*) AS row_count FROM log
        WHERE CAST(ingested_at AS DATE) >= DATE '2024-01-31' - 20 GROUP BY ALL"""),
    "p1_staging": _with("own", """
        SELECT j->>'source' AS source, j->>'source_id' AS source_id, TIMESTAMP '2024-01-01 00:00:00' AS ingested_at,
          t->>'slug' AS slug, t->>'company_name' AS company_name, t->>'title' AS title, t->>'description' AS description,
          t->>'url' AS url, t->>'location' AS location, CAST(t->>'remote' AS BOOLEAN) AS remote,
          CAST(t->>'created_at' AS BIGINT) AS created_at_epoch,
          make_timestamp(CAST(t->>'created_at' AS BIGINT) * 1000000) AS posting_created_at
        FROM (SELECT j, j->'typed' AS t FROM own) WHERE json_type(t) = 'OBJECT'"""),
    "p8_fct_postings": _with("fct", "SELECT * FROM fct"),
    "p9_city": _with("post", """
        SELECT event_id, CASE event_id % 12 WHEN 0 THEN 'Berlin' WHEN 1 THEN 'Munich' WHEN 2 THEN 'Hamburg' WHEN 3 THEN 'Frankfurt'
            WHEN 4 THEN 'Cologne' WHEN 5 THEN 'Vienna' WHEN 6 THEN 'Zurich' WHEN 9 THEN 'Vienna'
            ELSE nullif(trim(location), '') END AS city, nullif(trim(location), '') AS location_text FROM post"""),
    "p10_country": _with("post", f"""
        SELECT location, {_COUNTRY_OF_POST} AS country_code, count(*) AS row_count FROM post GROUP BY ALL"""),
    "p13_posting_tags": _with("tags", "SELECT * FROM tags"),
    "p13_log_tags": _with("log", """
        SELECT tag, count(*) AS occurrences, max(ingested_at) AS last_seen_at
        FROM (SELECT ingested_at, lower(unnest(CAST(CAST(tags_json AS JSON) AS VARCHAR[]))) AS tag FROM log)
        WHERE tag IS NOT NULL GROUP BY tag"""),
    "p17_salary_mentions": _with("salaries", "SELECT * FROM salaries"),
    "p17_salary_in_documents": r"""
        SELECT doc_id, raw_salary, salary_eur, CASE WHEN salary_eur >= 130000 THEN '130k+' WHEN salary_eur >= 100000 THEN '100-130k'
            WHEN salary_eur >= 80000 THEN '80-100k' WHEN salary_eur >= 60000 THEN '60-80k'
            WHEN salary_eur >= 40000 THEN '40-60k' ELSE '<40k' END AS salary_band
        FROM (SELECT doc_id, raw_salary, try_cast(translate(raw_salary, '.,', '') AS INTEGER) AS salary_eur
              FROM (SELECT doc_id, regexp_extract(text || printf(' %d.%03d EUR', n_chars % 90 + 10, doc_id % 1000),
                      '(\d{2,3}[\.,]?\d{3})\s*(?:€|EUR|euro)', 1) AS raw_salary FROM documents))""",
    "p22_week": """
        SELECT CAST(date_trunc('week', o_orderdate) AS TIMESTAMP) AS week, count(*) AS order_count FROM orders GROUP BY ALL""",
    "p29_posting_key": _with("log", """
        SELECT source || '|' || source_id AS posting_key, count(*) AS row_count FROM log GROUP BY ALL"""),
    "w1_latest_posting": _with("silver", "SELECT * FROM silver"),
    "w2_streaming_upsert": _with("located", """
        SELECT event_id, source, source_id, title, location, ingested_at, posting_created_at FROM located"""),
    "w2_replayed_upsert": _with("located", """
        SELECT event_id, source, source_id, title, location, ingested_at, posting_created_at FROM located"""),
    "a1_dim_company": _with("companies", "SELECT * FROM companies"),
    "a2_remote_policy": _with("remote_daily", "SELECT * FROM remote_daily"),
    "a3_skill_demand": _with("demand", "SELECT * FROM demand"),
    "a3_skill_demand_unnested": _with("tags skills silver", """
        SELECT CAST(date_trunc('day', posting_created_at) AS TIMESTAMP) AS posting_date, skill, country_code,
          count(DISTINCT tags.source || '|' || tags.source_id) AS posting_count,
          count(DISTINCT CASE WHEN remote THEN tags.source || '|' || tags.source_id END) AS remote_posting_count
        FROM tags JOIN skills ON tag = alias
        JOIN silver ON silver.source = tags.source AND silver.source_id = tags.source_id GROUP BY ALL"""),
    "a4_dim_skill": _with("catalogue_skills", "SELECT * FROM catalogue_skills"),
    "s12_seed_csv": _with("catalogue_skills", "SELECT * FROM catalogue_skills"),
    "c1_scd2_history": _with("history", "SELECT * FROM history"),
    "c2_scd2_apply": _with("observed silver", """
        , past AS (
          SELECT source, source_id, slug, title, company_name, remote, location, snapshot_observed_at,
            snapshot_observed_at AS valid_from,
            lead(snapshot_observed_at) OVER (PARTITION BY source, source_id ORDER BY snapshot_observed_at, event_id) AS valid_to
          FROM (SELECT *, row(title, company_name, remote, location) AS state, row_number() OVER w AS n,
                  lag(row(title, company_name, remote, location)) OVER w AS before
                FROM observed WHERE snapshot_observed_at < TIMESTAMP '2024-01-15'
                WINDOW w AS (PARTITION BY source, source_id ORDER BY snapshot_observed_at, event_id))
          WHERE n = 1 OR state IS DISTINCT FROM before),
        changed AS (
          SELECT s.source, s.source_id FROM silver s LEFT JOIN (SELECT * FROM past WHERE valid_to IS NULL) p
            ON p.source = s.source AND p.source_id = s.source_id
          WHERE p.source IS NULL OR row(p.title, p.company_name, p.remote, p.location)
            IS DISTINCT FROM row(s.title, s.company_name, s.remote, s.location))
        SELECT p.* REPLACE (CASE WHEN p.valid_to IS NULL AND EXISTS (SELECT 1 FROM changed c
            WHERE c.source = p.source AND c.source_id = p.source_id) THEN TIMESTAMP '2024-02-01' ELSE p.valid_to END AS valid_to)
        FROM past p
        UNION ALL
        SELECT source, source_id, slug, title, company_name, remote, location, last_seen_at, TIMESTAMP '2024-02-01', NULL
        FROM silver JOIN changed USING (source, source_id)"""),
    "c3_scd2_as_of": _with("history", """
        SELECT * FROM history WHERE valid_from <= TIMESTAMP '2024-01-15'
          AND coalesce(valid_to, TIMESTAMP '9999-01-01') > TIMESTAMP '2024-01-15'"""),
    "c2_history_runs": _with("two_runs", "SELECT * FROM two_runs"),
    "a2_rebuilt_days": _with("remote_daily", "SELECT * FROM remote_daily"),
    "a3_rebuilt_days": _with("demand", "SELECT * FROM demand"),
    "q2_stored_top_skills": _with("demand", f"""
        {_TOP_CELLS} WHERE posting_date >= TIMESTAMP '2024-01-01' GROUP BY ALL
        ORDER BY sum(posting_count) DESC, posting_date, skill, country_code NULLS LAST LIMIT 20"""),
    "j1_bucketed_demand": _with("demand", "SELECT * FROM demand"),
    "s13_build": _with("silver tags first_board_runs skills companies fct demand remote_daily salaries", f"""
        SELECT table_name, row_text, count(*) AS row_count FROM ({_BUILT}
          UNION ALL SELECT 'gate', '0' UNION ALL SELECT 'gate', '1') GROUP BY ALL"""),
    "q1_postings": _with("fct", f"SELECT {_POSTING} FROM fct {_NEWEST_FIRST} LIMIT 50"),
    "q1_postings_by_skill": _with("fct tags skills", f"""
        SELECT {_POSTING} FROM (SELECT fct.* FROM fct JOIN tags ON tags.source_id = posting_id JOIN skills ON alias = tag
          WHERE skill = 'python') {_NEWEST_FIRST} LIMIT 500"""),
    "q1_postings_filtered": _with("fct tags skills", f"""
        SELECT {_POSTING} FROM fct WHERE country_code = 'DE' AND remote AND posting_id IN (
          SELECT source_id FROM tags JOIN skills ON alias = tag WHERE skill = 'spark') {_NEWEST_FIRST} LIMIT 20"""),
    "q2_top_skills": _with("demand", f"""
        {_TOP_CELLS} WHERE posting_date >= TIMESTAMP '2024-01-01' GROUP BY ALL
        ORDER BY sum(posting_count) DESC, posting_date, skill, country_code NULLS LAST LIMIT 20"""),
    "q2_top_skills_country": _with("demand", f"""
        {_TOP_CELLS} WHERE posting_date >= TIMESTAMP '2023-01-31' AND country_code = 'DE' GROUP BY ALL
        ORDER BY sum(posting_count) DESC, posting_date, skill, country_code NULLS LAST LIMIT 200"""),
    "q3_totals": _with("fct", """
        SELECT count(*) AS postings, count(*) FILTER (remote) AS remote_count, count(DISTINCT company_name) AS companies,
          count(DISTINCT country_code) AS countries FROM fct"""),
    "q4_top_skills_total": _with("demand", """
        SELECT skill, CAST(sum(posting_count) AS BIGINT) AS postings FROM demand
        WHERE posting_date >= TIMESTAMP '2024-01-01' GROUP BY skill ORDER BY postings DESC, skill LIMIT 20"""),
    "q5_weekly_remote": _with("remote_daily", _WEEKLY),
    "q5_weekly_remote_pivot": _with("remote_daily", f"""
        SELECT week, max(remote_share) FILTER (country_code = 'DE') AS "DE", max(remote_share) FILTER (country_code = 'AT') AS "AT",
          max(remote_share) FILTER (country_code = 'CH') AS "CH" FROM ({_WEEKLY}) GROUP BY week"""),
    "q6_skill_names": _with("demand", "SELECT DISTINCT skill FROM demand"),
    "q6_skill_series": _with("demand", f"{_SERIES} WHERE skill IN ('python', 'spark') AND country_code = 'DE' GROUP BY ALL"),
    "q6_skill_series_default": _with("demand", f"""
        {_SERIES} WHERE skill IN (SELECT DISTINCT skill FROM demand ORDER BY skill LIMIT 6) GROUP BY ALL"""),
    "q7_top_companies": _with("companies", """
        SELECT * EXCLUDE (first_seen_at) FROM companies ORDER BY posting_count DESC, company_name LIMIT 100"""),
    "u1_table_diff": _with("silver", """
        , now AS (SELECT source_id, title, company_name, city_normalized, country_code, remote, url, posting_created_at FROM silver),
        first AS (SELECT DISTINCT ON (source, source_id) *, lower(location) AS place FROM log
          ORDER BY source, source_id, ingested_at, event_id),
        before AS (SELECT source_id, title, company_name,
          """ + _city("place", "location") + """ AS city,
          """ + _COUNTRY_OF_POST + """ AS country_code, remote, url, posting_created_at FROM first)
        SELECT (SELECT count(*) FROM now) = (SELECT count(*) FROM before) AS row_count_stable,
          (SELECT count(*) FROM (SELECT * FROM now EXCEPT SELECT * FROM before)) AS only_in_a,
          (SELECT count(*) FROM (SELECT * FROM before EXCEPT SELECT * FROM now)) AS only_in_b"""),
    "u1_table_diff_all": f"""
        SELECT (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') = (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'R')
            AS row_count_stable,
          (SELECT count(*) FROM ({_LINE_SIDE} = 'R' EXCEPT ALL {_LINE_SIDE} <> 'R')) AS only_in_a,
          (SELECT count(*) FROM ({_LINE_SIDE} <> 'R' EXCEPT ALL {_LINE_SIDE} = 'R')) AS only_in_b""",
    "u2_blend": _with("silver", f"""
        SELECT source, source_id AS posting_id, title, company_name, remote, posting_created_at, city_normalized AS city, country_code
        FROM silver
        UNION ALL
        SELECT *, NULL, NULL FROM ({adapters.ORDER_BOARD.format(orders="orders")})"""),
    "g_bronze_report": _with("own", """
        SELECT 'bronze.ingested_at.readable' AS rule, count(*) FILTER (j->>'source_id' LIKE '%7') AS failed_rows,
          count(*) FILTER (j->>'source_id' LIKE '%7') = 0 AS passed FROM own"""),
    "g_spoilt_report": _with(" ".join(f"spoilt_{cte}" for cte in _CTE_OF.values()), f"""
        SELECT rule, n AS failed_rows, n = 0 AS passed FROM ({_quality("spoilt_", (13, 8, 1))})"""),
    "g_quality_report": _with("silver tags fct companies catalogue_skills demand remote_daily salaries", f"""
        SELECT rule, n AS failed_rows, n = 0 AS passed FROM ({_quality()})"""),
}
