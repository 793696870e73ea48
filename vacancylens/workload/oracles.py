"""The registered queries in SQL, written independently of the DataFrame code."""

# Cleaned documents, one row per order with lines (see ``view.documents``).
_DETAILS = """
details AS (
  SELECT l_orderkey,
         min(l_extendedprice) / 4.1 AS salary_min,
         max(l_extendedprice) / 1.7 AS salary_max,
         CASE WHEN min(l_linestatus) = 'O' THEN 'B2B' ELSE 'Permanent' END AS contract_type,
         min(l_partkey) AS p_partkey
  FROM lineitem GROUP BY l_orderkey
),
all_docs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, c_name AS name, epoch_us(o_orderdate) // 1000 AS posted,
         p_name AS title, p_brand AS technology,
         upper(p_type[1]) || lower(p_type[2:]) AS category,
         'offer-' || o_orderkey AS url, o_orderstatus = 'O' AS remote, contract_type,
         salary_min, salary_max, (salary_max + salary_min) / 2 AS salary_mean,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'EUR' ELSE 'PLN' END AS currency
  FROM orders JOIN details ON o_orderkey = l_orderkey
  JOIN part USING (p_partkey) JOIN customer ON c_custkey = o_custkey
),
docs AS (SELECT * FROM all_docs WHERE currency = 'PLN'),
levels AS (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id,
         CASE l_returnflag WHEN 'N' THEN 'Junior' WHEN 'A' THEN 'Mid' ELSE 'Senior' END AS seniority
  FROM lineitem
),
cities AS (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id, n_name AS city,
         CAST(49.0 + n_nationkey * 0.25 AS DOUBLE) AS lat, CAST(14.0 + n_nationkey * 0.5 AS DOUBLE) AS lon
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
)"""
_DOCS = "WITH" + _DETAILS

# Raw postings, one per order line, and the cleaning steps (see ``view.raw_postings``).
_CLEAN = """
WITH raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Customer ' || o_custkey AS name, epoch_us(o_orderdate) // 1000 AS posted,
         CASE WHEN p_name = 'old bolt' THEN 'react' ELSE p_name END AS title,
         CASE p_brand WHEN 'Brand#1' THEN 'Node.js' WHEN 'Brand#2' THEN 'React' WHEN 'Brand#3' THEN 'Angular'
              WHEN 'Brand#4' THEN '.NET' WHEN 'Brand#5' THEN 'AWS' WHEN 'Brand#6' THEN 'iOS'
              WHEN 'Brand#7' THEN 'PHP' WHEN 'Brand#8' THEN 'SQL' WHEN 'Brand#9' THEN ''
              WHEN 'Brand#10' THEN 'NaN' WHEN 'Brand#11' THEN NULL ELSE p_brand END AS technology,
         CASE p_type WHEN 'MEDIUM' THEN 'businessAnalyst' WHEN 'LARGE' THEN 'projectManager'
              WHEN 'SMALL' THEN 'ux/ui' WHEN 'PROMO' THEN 'devOPS' WHEN 'ECONOMY' THEN 'backend'
              ELSE 'it''s QAOps' END AS category,
         CASE l_returnflag WHEN 'N' THEN ['Junior'] WHEN 'A' THEN ['Senior', 'Mid'] ELSE [] END AS seniority,
         'offer-' || l_orderkey || '-' || l_linenumber AS url,
         o_orderstatus = 'O' AS remote,
         CASE WHEN l_linenumber = 7 THEN [] WHEN l_linenumber % 3 = 0 THEN [n_name]
              ELSE [n_name, 'nation_' || (CAST(trunc(l_quantity) AS INTEGER) % 30)] END AS places,
         CASE WHEN l_discount <> 0 THEN l_extendedprice / 4 END AS salary_min,
         CASE WHEN l_tax <> 0 THEN l_extendedprice / 1.5 END AS salary_max,
         CASE WHEN l_linestatus = 'O' THEN 'b2b' WHEN l_quantity > 10 THEN 'permanent' ELSE '' END AS contract_type,
         CASE WHEN l_linenumber % 4 = 0 THEN 'EUR' ELSE 'PLN' END AS currency,
         row_number() OVER (PARTITION BY o_orderkey
                            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS nth
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
),
kept AS (SELECT * FROM raw WHERE nth = 1 AND currency = 'PLN'),
gazetteer AS (
  SELECT lower(n_name) AS alias, 'City ' || n_nationkey AS city,
         CAST(49.0 + n_nationkey * 0.25 AS DOUBLE) AS lat, CAST(14.0 + n_nationkey * 0.5 AS DOUBLE) AS lon
  FROM nation WHERE n_nationkey <> 3 AND n_regionkey <> 0
),
placed AS (
  SELECT id, pos, g.city, lat, lon
  FROM (SELECT id, unnest(places) AS place, generate_subscripts(places, 1) AS pos FROM kept) p
  LEFT JOIN gazetteer g ON lower(p.place) = g.alias
)"""

_SUMMARY = """count(*) AS n, round(avg(salary_mean), 4) AS mean, round(stddev_samp(salary_mean), 4) AS stddev,
 min(salary_mean) AS min, round(quantile_cont(salary_mean, 0.25), 4) AS p25,
 round(quantile_cont(salary_mean, 0.5), 4) AS p50, round(quantile_cont(salary_mean, 0.75), 4) AS p75,
 max(salary_mean) AS max"""


def _top_share(name: str, n: int) -> str:
    return f"""{_DOCS},
    top AS (SELECT {name}, count(*) AS n FROM docs WHERE {name} IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT {n})
    SELECT {name}, n, n / (SELECT sum(n) FROM top) AS share FROM top"""


_FLOW = f"""{_DOCS},
cats AS (SELECT category FROM docs GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3),
techs AS (SELECT technology FROM docs GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 12),
edges AS (
  SELECT category, technology, count(*) AS n FROM docs
  WHERE category IN (FROM cats) AND technology IN (FROM techs) GROUP BY 1, 2 HAVING count(*) >= 90
),
nodes AS (
  SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS node_id, label
  FROM (SELECT category AS label FROM edges UNION SELECT technology FROM edges)
)"""


def _cities(condition: str, tail: str) -> str:
    return f"""{_DOCS}
    SELECT city, count(id) AS job_counts, round(avg(salary_mean), 3) AS salary_mean,
           round(avg(lat), 3) AS lat, round(avg(lon), 3) AS lon
    FROM docs JOIN cities USING (id) WHERE {condition} GROUP BY city {tail}"""


def _level(seniority: str) -> str:
    return f"id IN (SELECT id FROM levels WHERE seniority = '{seniority}')"


_TOP_CITIES = "ORDER BY count(*) DESC, city LIMIT 15"

_TECH_ROWS = f"""{_DOCS},
exploded AS (SELECT id, technology, salary_mean, seniority FROM docs JOIN levels USING (id)),
top AS (SELECT technology FROM exploded GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 8)"""


def _contract_rows(n: int) -> str:
    return f"""{_DOCS},
    top AS (SELECT technology FROM docs GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {n})"""


def _describe(relation: str, columns: list[str], condition: str, head: str = "") -> str:
    statistics = {
        "n": "count({c})",
        "mean": "avg({c})",
        "stddev": "stddev_samp({c})",
        "min": "min({c})",
        "p25": "quantile_cont({c}, 0.25)",
        "p50": "quantile_cont({c}, 0.5)",
        "p75": "quantile_cont({c}, 0.75)",
        "max": "max({c})",
    }
    rows = []
    for name, formula in statistics.items():
        cells = ", ".join(f"round(CAST({formula.format(c=c)} AS DOUBLE), 4) AS {c}" for c in columns)
        rows.append(f"SELECT '{name}' AS statistic, {cells} FROM {relation} WHERE {condition}")
    return head + " UNION ALL ".join(rows)


_SALARIES = ["salary_min", "salary_max", "salary_mean"]

# Title case and capitalisation for ASCII text.
_TITLED = "list_aggregate(list_transform(regexp_extract_all({c}, '[A-Za-z]+|[^A-Za-z]+'), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', '')"
_CAPITAL = "upper({c}[1]) || lower({c}[2:])"


def _event_rows(condition: str = "true") -> str:
    return f"""
    SELECT (1704067200 + (event_id // 2000) * 3600) || '_nofluffjobs' AS key, CAST(event_id % 2000 AS INTEGER) AS pos,
           CAST(event_id AS VARCHAR) AS id, 'User ' || user_id AS name, epoch_us(ts) // 1000 AS posted,
           event_type AS technology, event_type = 'view' AS "fullyRemote", value * 2 AS salary_to,
           'Warsaw' AS first_city
    FROM events WHERE {condition}"""


_EVENTS = _event_rows()

# The documents of the newest snapshot of events.
_SERVED = """WITH docs AS (
  SELECT CAST(event_id AS VARCHAR) AS id, upper(event_type[1]) || event_type[2:] AS technology, 'Backend' AS category,
         event_type = 'view' AS remote, 'B2B' AS contract_type, (value * 2 + value) / 2 AS salary_mean
  FROM events WHERE event_id // 2000 = (SELECT max(event_id // 2000) FROM events) AND event_type <> 'error'
),
levels AS (SELECT id, 'Mid' AS seniority FROM docs),
cities AS (SELECT id, 'Warszawa' AS city, CAST(52.23 AS DOUBLE) AS lat, CAST(21.01 AS DOUBLE) AS lon FROM docs)"""


def _all_insights(head: str) -> str:
    """Every stored insight as ``(insight, label, n, value)``, over docs, levels and cities."""

    def share(name: str, relation: str, top: str = "") -> str:
        counted = f"SELECT {name} AS label, count(*) AS n FROM {relation} GROUP BY 1 {top}"
        return f"SELECT label, n, round(n / sum(n) OVER (), 6) AS value FROM ({counted})"

    def top(name: str) -> str:
        return f"HAVING {name} IS NOT NULL ORDER BY n DESC, 1 LIMIT 12"

    def city(name: str, level: str | None) -> str:
        rows = "docs JOIN cities USING (id)" + (f" JOIN levels USING (id) WHERE seniority = '{level}'" if level else "")
        return f"SELECT city AS label, count(id) AS n, round(avg(salary_mean), 3) AS value FROM {rows} GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15"

    bin_start = "CAST(floor(salary_mean / 1000) * 1000 AS BIGINT)"
    by_level = "docs JOIN levels USING (id) WHERE technology IN (FROM level_top) AND salary_mean < 35000"
    by_contract = "docs WHERE technology IN (FROM post_top) AND contract_type IN ('B2B', 'Permanent') AND salary_mean < 40000"
    parts = {
        "technology_share": share("technology", "docs", top("technology")),
        "category_share": share("category", "docs", top("category")),
        "seniority_share": share("seniority", "docs JOIN levels USING (id)"),
        "remote_share": share("CASE WHEN remote THEN 'Yes' ELSE 'No' END", "docs"),
        "category_technology_flow": "SELECT category || '/' || technology AS label, n, NULL AS value FROM edges",
        "category_technology_nodes": """
            SELECT label, row_number() OVER (ORDER BY label) - 1 AS n, NULL AS value
            FROM (SELECT category AS label FROM edges UNION SELECT technology FROM edges)""",
        "salary_by_city": city("salary_by_city", None),
        "salary_by_city_junior": city("salary_by_city_junior", "Junior"),
        "salary_by_city_mid": city("salary_by_city_mid", "Mid"),
        "salary_by_city_senior": city("salary_by_city_senior", "Senior"),
        "salary_histogram": f"""
            SELECT seniority || '/' || {bin_start} AS label, count(*) AS n, NULL AS value
            FROM docs JOIN levels USING (id) WHERE salary_mean > 0 AND salary_mean < 40000 GROUP BY 1""",
        "technology_salary_distribution": f"""
            SELECT seniority || '/' || technology AS label, count(*) AS n, round(quantile_cont(salary_mean, 0.5), 4) AS value
            FROM {by_level} GROUP BY 1 HAVING count(*) > 3""",
        "contract_salary_distribution": f"""
            SELECT contract_type || '/' || technology AS label, count(*) AS n, round(quantile_cont(salary_mean, 0.5), 4) AS value
            FROM {by_contract} GROUP BY 1""",
        "technology_salary_shape": f"""
            SELECT concat_ws('/', seniority, technology, {bin_start}) AS label, count(*) AS n, NULL AS value FROM {by_level} GROUP BY 1""",
        "contract_salary_shape": f"""
            SELECT concat_ws('/', contract_type, technology, {bin_start}) AS label, count(*) AS n, NULL AS value FROM {by_contract} GROUP BY 1""",
    }
    shown = " UNION ALL ".join(f"SELECT '{name}' AS insight, label, n, CAST(value AS DOUBLE) AS value FROM ({sql})" for name, sql in parts.items())
    return f"""{head},
    cats AS (SELECT category FROM docs GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 12),
    techs AS (SELECT technology FROM docs GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 12),
    edges AS (
      SELECT category, technology, count(*) AS n FROM docs
      WHERE category IN (FROM cats) AND technology IN (FROM techs) GROUP BY 1, 2 HAVING count(*) >= 12
    ),
    level_top AS (SELECT technology FROM docs JOIN levels USING (id) GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 8),
    post_top AS (SELECT technology FROM docs GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 8)
    {shown}"""


ORACLES: dict[str, str] = {
    "cube_insights": _all_insights(_DOCS),
    "served_insight_tables": _all_insights(_SERVED),
    "technology_share": _top_share("technology", 12),
    "category_share": _top_share("category", 3),
    "seniority_share": f"""{_DOCS}, c AS (SELECT seniority, count(*) AS n FROM docs JOIN levels USING (id) GROUP BY 1)
        SELECT seniority, n, n / (SELECT sum(n) FROM c) AS share FROM c""",
    "remote_share": f"""{_DOCS},
        c AS (SELECT CASE WHEN remote THEN 'Yes' ELSE 'No' END AS remote, count(*) AS n FROM docs GROUP BY 1)
        SELECT remote, n, n / (SELECT sum(n) FROM c) AS share FROM c""",
    "category_technology_flow": f"""{_FLOW}
        SELECT category, technology, s.node_id AS source_id, t.node_id AS target_id, n
        FROM edges JOIN nodes s ON s.label = category JOIN nodes t ON t.label = technology""",
    "flow_nodes": f"{_FLOW} SELECT node_id, label FROM nodes",
    "salary_by_city": _cities("true", _TOP_CITIES),
    "salary_by_city_junior": _cities(_level("Junior"), _TOP_CITIES),
    "salary_by_city_mid": _cities(_level("Mid"), _TOP_CITIES),
    "salary_by_city_senior": _cities(_level("Senior"), _TOP_CITIES),
    "salary_by_city_min_jobs": _cities("true", "HAVING count(id) > 1500"),
    "salary_by_city_min_jobs_junior": _cities(_level("Junior"), "HAVING count(id) > 950"),
    "salary_by_city_min_jobs_mid": _cities(_level("Mid"), "HAVING count(id) > 950"),
    "salary_by_city_min_jobs_senior": _cities(_level("Senior"), "HAVING count(id) > 950"),
    "salary_histogram": f"""{_DOCS}
        SELECT seniority, CAST(floor(salary_mean / 1000) * 1000 AS BIGINT) AS bin_start, count(*) AS n
        FROM docs JOIN levels USING (id) WHERE salary_mean > 0 AND salary_mean < 40000 GROUP BY 1, 2""",
    "technology_salary_distribution": f"""{_TECH_ROWS}
        SELECT seniority, technology, {_SUMMARY} FROM exploded
        WHERE technology IN (FROM top) AND salary_mean < 35000 GROUP BY 1, 2 HAVING count(*) > 300""",
    "technology_salary_distribution_all_groups": f"""{_TECH_ROWS}
        SELECT seniority, technology, {_SUMMARY} FROM exploded
        WHERE technology IN (FROM top) AND salary_mean < 40000 GROUP BY 1, 2""",
    "technology_salary_shape": f"""{_TECH_ROWS}
        SELECT seniority, technology, CAST(floor(salary_mean / 1000) * 1000 AS BIGINT) AS bin_start, count(*) AS n
        FROM exploded WHERE technology IN (FROM top) AND salary_mean < 35000 GROUP BY 1, 2, 3""",
    "contract_salary_distribution": f"""{_contract_rows(8)}
        SELECT contract_type, technology, {_SUMMARY} FROM docs
        WHERE technology IN (FROM top) AND salary_mean < 40000 GROUP BY 1, 2""",
    "contract_salary_distribution_raw_names": f"""{_contract_rows(5)}
        SELECT lower(contract_type) AS contract_type, technology, {_SUMMARY} FROM docs
        WHERE technology IN (FROM top) AND salary_mean < 40000 GROUP BY 1, 2""",
    "contract_salary_shape": f"""{_contract_rows(8)}
        SELECT contract_type, technology, CAST(floor(salary_mean / 1000) * 1000 AS BIGINT) AS bin_start, count(*) AS n
        FROM docs WHERE technology IN (FROM top) AND salary_mean < 40000 GROUP BY 1, 2, 3""",
    "salary_describe": _describe("docs", _SALARIES, "salary_min > 0 AND salary_max > salary_min", _DOCS),
    "salary_describe_above": _describe("docs", _SALARIES, "salary_min > 5000 AND salary_max > salary_min", _DOCS),
    "account_describe": _describe("customer", ["c_acctbal"], "true"),
    "crowded_describe": _describe(
        "(SELECT 1000000.0::DOUBLE + l_extendedprice / 1000 AS price, l_quantity AS quantity FROM lineitem)", ["price", "quantity"], "true"
    ),
    "clean_postings": f"""{_CLEAN},
        named AS (
          SELECT *, CASE lower(technology) WHEN 'node.js' THEN 'Node' WHEN 'react' THEN 'JavaScript'
                         WHEN 'angular' THEN 'JavaScript' WHEN '.net' THEN '.Net' WHEN 'aws' THEN 'AWS'
                         WHEN 'ios' THEN 'iOS' WHEN 'php' THEN 'PHP' WHEN 'sql' THEN 'SQL'
                         ELSE {_CAPITAL.format(c="technology")} END AS tech,
                 regexp_replace(category, '(\\w)([A-Z])', '\\1 \\2', 'g') AS cat
          FROM kept
        )
        SELECT id, name, posted, CASE title WHEN 'react' THEN 'javascript' ELSE title END AS title,
               CASE WHEN tech NOT IN ('', 'Nan') THEN tech END AS technology,
               {_TITLED.format(c="cat")} AS category, url, remote,
               CASE contract_type WHEN 'b2b' THEN 'B2B' WHEN 'permanent' THEN 'Permanent' END AS contract_type,
               salary_min, salary_max,
               CASE WHEN salary_min IS NULL THEN salary_max WHEN salary_max IS NULL THEN salary_min
                    ELSE (salary_max + salary_min) / 2 END AS salary_mean,
               coalesce((SELECT string_agg(coalesce(city, '?'), ',' ORDER BY pos) FROM placed p WHERE p.id = named.id), '') AS city,
               array_to_string(seniority, ',') AS seniority
        FROM named""",
    "clean_locations": f"{_CLEAN} SELECT id, city, lat, lon FROM placed WHERE city IS NOT NULL",
    "clean_seniorities": f"""{_CLEAN}
        SELECT id, unnest(CASE WHEN len(seniority) = 0 THEN [NULL] ELSE seniority END) AS seniority FROM kept""",
    "clean_strings": f"""
        WITH names AS (
          SELECT p_type || '/' || p_name AS name FROM part
          UNION ALL SELECT 'camelCase' || upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:]
                    || ' ' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] FROM part
          UNION ALL SELECT CASE WHEN p_size > 25 THEN 'javascript' ELSE '' END FROM part
          UNION ALL SELECT lower(c_mktsegment) FROM customer
          UNION ALL SELECT CASE WHEN c_acctbal > 0 THEN 'Nan' END FROM customer
        ),
        shown AS (
          SELECT lower(name) AS lowered, regexp_replace(name, '(\\w)([A-Z])', '\\1 \\2', 'g') AS split,
                 {_TITLED.format(c="name")} AS titled,
                 CASE WHEN name = 'javascript' THEN 'JavaScript' ELSE {_CAPITAL.format(c="name")} END AS capitalized,
                 lower(name) AS keyword
          FROM names
        )
        SELECT {", ".join(f"CASE WHEN {c} NOT IN ('', 'NaN', 'Nan', 'nan') THEN {c} END AS {c}"
                          for c in ("lowered", "split", "titled", "capitalized", "keyword"))}, count(*) AS n
        FROM shown GROUP BY ALL""",
    "row_means": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               CASE WHEN l_tax <> 0 AND l_discount <> 0 THEN (l_tax + l_discount) / 2
                    ELSE coalesce(nullif(l_tax, 0), nullif(l_discount, 0)) END AS mean
        FROM lineitem""",
    "currency_filter": f"{_DOCS} SELECT id, currency, salary_mean FROM docs",
    "geo_lookup": """
        WITH wanted AS (
          SELECT s_suppkey, unnest([lower(n_name), 'nation_24', 'atlantis']) AS alias, unnest([0, 1, 2]) AS pos
          FROM supplier JOIN nation ON s_nationkey = n_nationkey
        )
        SELECT s_suppkey, pos, 'City ' || n_nationkey AS city, CAST(49.0 + n_nationkey * 0.25 AS DOUBLE) AS lat,
               CAST(14.0 + n_nationkey * 0.5 AS DOUBLE) AS lon
        FROM wanted LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 3 AND n_regionkey <> 0)
          ON lower(n_name) = alias""",
    "address_gazetteer": """
        SELECT c_name AS alias, c_mktsegment AS city, r_name AS country, c_acctbal AS lat, c_acctbal AS lon
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "dedupe_first": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1""",
    "duplicate_members": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
        QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
    "duplicate_profile": """
        SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys,
               count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_duplicates FROM lineitem""",
    "null_profile": """
        SELECT 'l_orderkey' AS column_name, count(*) - count(l_orderkey) AS n_null FROM lineitem
        UNION ALL SELECT 'l_discount', count(*) - count(nullif(l_discount, 0)) FROM lineitem
        UNION ALL SELECT 'l_tax', count(*) - count(nullif(l_tax, 0)) FROM lineitem
        UNION ALL SELECT 'l_returnflag', count(*) - count(nullif(l_returnflag, 'N')) FROM lineitem""",
    "row_counts": "SELECT count(*) AS n_rows FROM lineitem",
    "technology_counts": f"""{_CLEAN}
        SELECT technology, count(*) AS n FROM raw WHERE technology IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 30""",
    "category_counts": f"{_CLEAN} SELECT category, count(*) AS n FROM raw GROUP BY 1",
    "seniority_list_counts": f"""{_DOCS},
        lists AS (SELECT id, string_agg(seniority, ',' ORDER BY seniority) AS seniority FROM levels GROUP BY id)
        SELECT seniority, count(*) AS n FROM docs JOIN lists USING (id) GROUP BY 1""",
    "top_technology_rows": f"""{_contract_rows(5)}
        SELECT id, technology FROM docs WHERE technology IN (FROM top)""",
    "large_group_rows": f"""{_DOCS}
        SELECT id, technology, seniority FROM docs JOIN levels USING (id)
        QUALIFY count(technology) OVER (PARTITION BY seniority, technology) > 330""",
    "salary_ranges": f"""{_DOCS}
        SELECT id, technology, contract_type, CASE WHEN remote THEN 'Yes' ELSE 'No' END AS remote, salary_mean FROM docs
        WHERE salary_mean > 5000 AND salary_mean < 20000 AND technology IN ('Brand#1', 'Brand#2', 'Brand#3')
          AND contract_type = 'B2B'""",
    "seniority_sorted": f"""{_DOCS}
        SELECT id, seniority, CASE seniority WHEN 'Junior' THEN 1 WHEN 'Mid' THEN 2 ELSE 3 END AS seniority_rank
        FROM docs JOIN levels USING (id)""",
    "postings_table": f"""{_DOCS}
        SELECT id, name, strftime(make_timestamp(posted * 1000), '%Y-%m-%d %H:%M:%S') AS posted, title, technology,
               category, url, remote FROM docs""",
    "salaries_table": f"{_DOCS} SELECT id, contract_type, salary_min, salary_max, salary_mean FROM docs",
    "locations_table": f"{_DOCS} SELECT id, city, lat, lon FROM docs JOIN cities USING (id)",
    "seniorities_table": f"{_DOCS} SELECT id, seniority FROM docs JOIN levels USING (id)",
    "contract_violations": """
        WITH c AS (SELECT *, CASE WHEN c_acctbal < 0 THEN 'debtor' ELSE CAST(c_custkey AS VARCHAR) END AS id FROM customer),
        found AS (
          SELECT 'postings' AS table_name, 'id' AS column_name, 'unique' AS rule, count(*) AS n FROM c
            WHERE id IN (SELECT id FROM c GROUP BY id HAVING count(*) > 1)
          UNION ALL SELECT 'postings', 'posted', 'coercible', count(*) FROM c WHERE c_acctbal < 5000
          UNION ALL SELECT 'postings', 'remote', 'not_null', count(*) FROM c WHERE c_acctbal <= 100
          UNION ALL SELECT 'salaries', 'id', 'unique', count(*) FROM c
            WHERE id IN (SELECT id FROM c GROUP BY id HAVING count(*) > 1)
          UNION ALL SELECT 'salaries', 'contract_type', 'not_null', count(*) FROM c WHERE c_mktsegment = 'BUILDING'
          UNION ALL SELECT 'salaries', 'salary_min', 'at_least', count(*) FROM c WHERE c_acctbal < 0
          UNION ALL SELECT 'salaries', 'salary_max', 'coercible', count(*) FROM c WHERE c_acctbal > 9000
          UNION ALL SELECT 'salaries', 'salary_mean', 'at_least', count(*) FROM c WHERE c_acctbal < 0
          UNION ALL SELECT 'locations', 'lat', 'at_least', count(*) FROM c WHERE c_acctbal / 50 < -90
          UNION ALL SELECT 'locations', 'lat', 'at_most', count(*) FROM c WHERE c_acctbal / 50 > 90
          UNION ALL SELECT 'locations', 'lon', 'at_least', count(*) FROM c WHERE c_acctbal / -50 < -180
          UNION ALL SELECT 'locations', 'lon', 'at_most', count(*) FROM c WHERE c_acctbal / -50 > 180
          UNION ALL SELECT 'seniorities', 'seniority', 'not_null', count(*) FROM c WHERE c_mktsegment = 'MACHINERY'
        )
        SELECT * FROM found WHERE n > 0""",
    "warehouse_roundtrip": f"""{_DOCS}
        SELECT id, contract_type, salary_min, salary_max, salary_mean,
               (SELECT count(*) FROM levels l WHERE l.id = docs.id) AS n_levels,
               (SELECT count(*) FROM cities c WHERE c.id = docs.id) AS n_cities
        FROM docs""",
    "snapshot_roundtrip": _EVENTS,
    "snapshot_metadata": """
        SELECT 'nofluffjobs' AS source_name, obtained || '_nofluffjobs' AS key, obtained,
               strftime(make_timestamp(obtained * 1000000), '%-d %B %Y') AS shown, n_postings
        FROM (SELECT 1704067200 + (event_id // 2000) * 3600 AS obtained, CAST(count(*) AS INTEGER) AS n_postings FROM events GROUP BY 1)""",
    "snapshot_freshness": """
        SELECT 'nofluffjobs' AS source_name,
               strftime(make_timestamp((1704067200 + chunk * 3600) * 1000000), '%-d %B %Y') AS obtained, count(*) AS n
        FROM (SELECT DISTINCT event_id // 2000 AS chunk FROM events) GROUP BY 1, 2""",
    "envelope_json": _EVENTS,
    "archive_roundtrip": _EVENTS,
    "lake_postings": _EVENTS,
    "compacted_lake": _EVENTS,
    "archived_heads": """
        SELECT 'nofluffjobs' AS source_name, obtained || '_nofluffjobs' AS key, obtained, n_postings, 1 AS n_files
        FROM (SELECT 1704067200 + (event_id // 2000) * 3600 AS obtained, count(*) AS n_postings FROM events GROUP BY 1)""",
    "large_snapshot": """
        SELECT CAST(event_id AS VARCHAR) AS id, upper(event_type[1]) || event_type[2:] AS technology,
               event_type = 'view' AS remote, 'B2B' AS contract_type, (value * 2 + value) / 2 AS salary_mean,
               epoch_us(ts) // 1000 AS posted
        FROM events WHERE event_type <> 'error'""",
    "repeated_batch": """
        SELECT (1704067200 + (event_id // 2000) * 3600) || '_nofluffjobs' AS key, count(*) AS n_postings,
               1 AS n_runs, 'stream-7' AS batch
        FROM events GROUP BY 1""",
    "landing_snapshots": f"SELECT * EXCLUDE (key) FROM ({_EVENTS})",
    "landing_archive": f"SELECT * EXCLUDE (key) FROM ({_EVENTS})",
    "incremental_ingest": _EVENTS,
    "latest_snapshot": """
        SELECT CAST(event_id AS VARCHAR) AS id, upper(event_type[1]) || event_type[2:] AS technology,
               event_type = 'view' AS remote, 'B2B' AS contract_type, (value * 2 + value) / 2 AS salary_mean,
               'Warszawa' AS city
        FROM events
        WHERE event_id // 2000 = (SELECT max(event_id // 2000) FROM events) AND event_type <> 'error'""",
    "served_insights": """
        WITH c AS (SELECT CASE WHEN event_type = 'view' THEN 'Yes' ELSE 'No' END AS remote, count(*) AS n FROM events
          WHERE event_id // 2000 = (SELECT max(event_id // 2000) FROM events) AND event_type <> 'error' GROUP BY 1)
        SELECT remote, n, n / (SELECT sum(n) FROM c) AS share FROM c""",
    "head_rows": """
        SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 12""",
    "latest_event_per_user": """
        SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "clean_several_snapshots": f"""
        SELECT key, upper(technology[1]) || technology[2:] AS technology, "fullyRemote" AS remote, count(*) AS n,
               round(sum((salary_to + salary_to / 2) / 2), 4) AS salary_sum
        FROM ({_event_rows("event_type <> 'error'")}) GROUP BY 1, 2, 3""",
    "iso_times": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS told,
               CAST(epoch(o_orderdate) AS BIGINT) AS epoch, strftime(o_orderdate, '%-d %B %Y') AS shown
        FROM orders""",
    "flatten_documents": """
        SELECT o_orderkey AS id, o_orderstatus AS order_status, o_totalprice AS order_price_total,
               o_custkey AS order_price_by FROM orders""",
    "page_keywords": """
        SELECT page_id, lower(trim(unnest(regexp_extract_all(html, '<div class="ad">([^<]*)</div>', 1)))) AS keyword
        FROM pages""",
    "page_keywords_nested": """
        SELECT page_id, lower(trim(unnest(regexp_extract_all(html, '<div class="ad">([^<]*)</div>', 1)) || '& more')) AS keyword
        FROM pages""",
    "posting_keywords": """
        SELECT page_id AS id, lower(trim(unnest(regexp_extract_all(html, '<div class="ad">([^<]*)</div>', 1)))) AS keyword
        FROM pages WHERE page_id % 3 <> 0""",
    "posting_urls": f"{_DOCS} SELECT id, 'https://nofluffjobs.com/pl/job/' || url AS page_url FROM docs",
}
ORACLES["geo_lookup_joined"] = ORACLES["clean_locations"]
