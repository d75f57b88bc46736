"""DuckDB twins of the Spark test views (``lotwright.sources.testviews``).

Each function returns the body of a CTE, so oracle queries read
``WITH silver AS (...) SELECT ...`` straight from the pre-registered tables.
"""

from __future__ import annotations

from lotwright.sources import testviews as TV


def q(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def pick(values: list, k: str) -> str:
    arr = "[" + ", ".join(q(v) + "::VARCHAR" if v is None else q(v) for v in values) + "]"
    return f"({arr})[({k}) % {len(values)} + 1]"


def silver_sql() -> str:
    k = "o_orderkey"
    p = "o_totalprice"
    name = (f"({pick(TV.CAR_NAMES, k)} || CASE {k} % 5 WHEN 1 THEN ' ' || ({k} % 4 + 1) || '.' || ({k} % 10) || 'A' "
            f"WHEN 2 THEN ' (COE till 0' || ({k} % 9 + 1) || '/20' || ({k} % 15 + 26) || ')' ELSE '' END)")
    day = "CAST(o_orderdate AS DATE)"
    posted = f"({day} + CAST({k} % 90 AS INTEGER))"
    return f"""
SELECT
  CAST({k} AS BIGINT) AS listing_id,
  {name} AS car_name,
  CASE WHEN {k} % 17 = 0 THEN NULL
       WHEN {k} % 19 = 0 THEN 'https://example.com/info/' || CAST({k} AS VARCHAR)
       ELSE '/used-cars/info/' || CAST({k} AS VARCHAR) END AS detail_url,
  {pick(TV.LISTING_TYPES, k)} AS listing_type,
  CAST(CASE WHEN {k} % 11 = 0 THEN NULL WHEN {k} % 101 = 0 THEN -100
       ELSE floor({p}) END AS BIGINT) AS price,
  CAST(CASE WHEN {k} % 4 <> 3 THEN floor({p} / 60) END AS BIGINT) AS installment,
  CAST(CASE WHEN {k} % 9 <> 0 THEN ({k} * 37) % 30000 + 5000 END AS BIGINT) AS depreciation,
  CASE WHEN {k} % 13 = 0 THEN 'N.A.'
       WHEN {k} % 5 = 0 THEN strftime({day}, '%Y-%m-%d')
       ELSE strftime({day}, '%d-%b-%Y') END AS reg_date,
  CASE WHEN {k} % 7 = 0 THEN CAST({k} % 10 AS VARCHAR) || 'y (renewed)'
       WHEN {k} % 17 = 0 THEN CAST({k} % 12 AS VARCHAR) || 'm ' || CAST({k} % 28 AS VARCHAR) || 'd'
       ELSE CAST({k} % 10 AS VARCHAR) || 'y ' || CAST({k} % 12 AS VARCHAR) || 'm' END
    AS coe_remaining,
  CAST(CASE WHEN {k} % 6 = 0 THEN NULL WHEN {k} % 997 = 0 THEN 5000000
       ELSE ({k} * 7919) % 200000 END AS BIGINT) AS mileage_km,
  CAST(1000 + ({k} % 30) * 100 AS INTEGER) AS engine_cap_cc,
  CAST({k} % 5 AS INTEGER) AS owners,
  {pick(TV.FUEL_TYPES, k)} AS fuel_type,
  CASE WHEN {k} % 19 = 0 THEN 'yesterday'
       WHEN {k} % 8 = 0 THEN strftime({posted}, '%Y-%m-%d')
       ELSE strftime({posted}, '%d-%b-%Y') END AS posted_date,
  {name} AS car_model,
  CAST(CAST(floor({p} / 4) AS BIGINT) % 120000 AS BIGINT) AS coe,
  CAST(500 + {k} % 3000 AS BIGINT) AS road_tax,
  CAST(CASE WHEN {k} % 8 = 0 THEN NULL WHEN {k} % 29 = 0 THEN 0
       ELSE ({k} * 131) % 90000 + 10000 END AS BIGINT) AS omv,
  CAST(({k} * 17) % 100000 AS BIGINT) AS arf,
  CASE WHEN {k} % 10 <> 9 THEN CAST({k} % 400 AS DOUBLE) + 0.5::DOUBLE END AS power,
  {pick(TV.TRANSMISSIONS, k)} AS transmission,
  CAST(CASE WHEN {k} % 31 = 0 THEN 0 ELSE 1990 + {k} % 35 END AS INTEGER) AS manufactured,
  CAST(({k} * 53) % 60000 AS BIGINT) AS dereg_value,
  CAST(1000 + {k} % 1500 AS INTEGER) AS curb_weight,
  CASE WHEN {k} % 53 = 0 THEN 'Delisted' WHEN {k} % 59 = 0 THEN NULL
       WHEN {k} % 61 = 0 THEN 'N.A.' WHEN {k} % 67 = 0 THEN 'Sold Out'
       WHEN o_orderstatus = 'O' THEN 'Available for sale'
       WHEN o_orderstatus = 'F' THEN 'SOLD'
       WHEN o_orderstatus = 'P' THEN 'Reserved' END AS status,
  CASE WHEN {k} % 3 <> 0 THEN 'LED headlights, keyless entry' END AS features,
  CASE WHEN {k} % 4 <> 0 THEN '19" rims, dashcam' END AS accessories,
  {pick(TV.VEHICLE_TYPES, k)} AS vehicle_type,
  CAST(o_orderdate AS TIMESTAMP) AS scraped_at
FROM orders"""


def feed_sql() -> str:
    k = "TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)"
    return f"""
SELECT
  user_id AS listing_id,
  event_id AS seq,
  ts,
  CAST(ts AS DATE) AS day,
  CAST(CASE WHEN event_type <> 'view' THEN floor(value * 100) END AS BIGINT) AS price,
  CAST(CASE WHEN {k} % 3 <> 0 THEN {k} * 100 END AS BIGINT) AS depreciation,
  CASE WHEN event_type = 'signup' THEN 'Reserved' WHEN event_type = 'purchase' THEN 'SOLD'
       WHEN event_type = 'error' THEN NULL ELSE 'Available' END AS status,
  '/used-cars/info/' || CAST(user_id AS VARCHAR) AS detail_url,
  CAST({k} AS INTEGER) AS owners
FROM events"""


def template_sql(templates: list[str], k: str) -> str:
    return f"replace({pick(templates, k)}, '{{k}}', CAST({k} AS VARCHAR))"


def sql_texts_sql() -> str:
    k = "o_orderkey"
    return f"SELECT {k} AS query_id, {template_sql(TV.SQL_TEMPLATES, k)} AS sql_text FROM orders"


def responses_sql() -> str:
    k = "(conv_id * 100 + turn)"
    return (f"SELECT {k} AS response_id, {template_sql(TV.RESPONSE_TEMPLATES, k)} || text AS text "
            "FROM conversations WHERE role = 'assistant'")


def reviews_sql() -> str:
    k = "(conv_id * 100 + turn)"
    return (f"SELECT {k} AS response_id, {template_sql(TV.REVIEW_TEMPLATES, k)} || chr(10) || text AS text "
            "FROM conversations WHERE role = 'assistant'")


def attempts_sql() -> str:
    return """SELECT conv_id AS session,
  CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS iteration,
  CASE WHEN (conv_id + turn) % 7 = 0 THEN 'Generation failed: timeout' END AS generation_error,
  (conv_id * 3 + turn) % 5 <> 0 AS safety_passed,
  (conv_id + 2 * turn) % 3 <> 0 AS approved,
  CASE WHEN (conv_id + turn) % 11 = 0 THEN 'no such column: x' END AS exec_error,
  CASE WHEN NOT ((conv_id * 3 + turn) % 5 <> 0) THEN 'Dangerous pattern detected'
       WHEN NOT ((conv_id + 2 * turn) % 3 <> 0) THEN 'Filter is wrong' END AS feedback
FROM conversations WHERE role = 'assistant'"""


def trace_steps_sql() -> str:
    name = pick(TV.STEP_NAMES, "turn")
    llm = f"{name} IN ('generate', 'review', 'explain')"
    prompt = f"CASE WHEN {llm} THEN (conv_id * 13 + turn * 7) % 900 + 100 ELSE 0 END"
    comp = f"CASE WHEN {llm} THEN (conv_id * 5 + turn * 3) % 200 + 10 ELSE 0 END"
    return f"""SELECT conv_id AS trace_id, CAST(turn AS INTEGER) AS step, {name} AS name,
  CAST((conv_id * 37 + turn * 11) % 1000 AS DOUBLE) + 0.5::DOUBLE AS duration_ms,
  CAST({prompt} AS BIGINT) AS prompt_tokens, CAST({comp} AS BIGINT) AS completion_tokens,
  CAST({prompt} + {comp} AS BIGINT) AS total_tokens,
  CASE WHEN {llm} THEN 'model-a' END AS model,
  CASE WHEN (conv_id + turn) % 13 = 0 THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN (conv_id + turn) % 13 = 0 THEN 'step failed' END AS error,
  CASE WHEN {llm} THEN '{{"input_tokens":' || CAST({prompt} AS VARCHAR) || ',"output_tokens":'
       || CAST({comp} AS VARCHAR) || ',"total_tokens":' || CAST({prompt} + {comp} AS VARCHAR) || '}}' END
    AS usage_metadata
FROM conversations"""
