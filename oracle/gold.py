"""DuckDB oracle of the silver -> gold transform.

Written independently of the Spark expressions: the brand lookup is a join
with a VALUES dimension, the engine-code split is one regex over the
single-spaced remainder, the keyword split uses a lazy prefix, and the value
score uses ``percent_rank()``.
"""

from __future__ import annotations

from lotwright.functions import lookups as LK
from lotwright.sources.testviews import TEST_AS_OF

from .views import q, silver_sql

TRIMWS = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def trim_ws(x: str) -> str:
    return TRIMWS.format(x=x)


def brand_dim_sql() -> str:
    seen = {}
    for b in LK.SINGLE_WORD_BRANDS:
        seen.setdefault(b.lower(), b)
    rows = ", ".join(f"({q(k)}, {q(v)})" for k, v in seen.items())
    return f"SELECT * FROM (VALUES {rows}) AS t(low, canon)"


def case_map(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def gold_ctes(as_of=TEST_AS_OF, silver_cte: str | None = None) -> str:
    """CTEs ``silver, g_clean, g_brand, g_split, tagged, gold0, scores, gold``."""
    silver = silver_cte if silver_cte is not None else silver_sql()
    clean = trim_ws("car_name")
    clean = f"regexp_replace({clean}, {q(LK.COE_SUFFIX_PATTERN)}, '', 'g')"
    clean = f"regexp_replace({clean}, {q(LK.RENEWED_SUFFIX_PATTERN)}, '', 'g')"
    multi_brand = " ".join(
        f"WHEN starts_with(lower(clean), {q(b.lower())}) THEN {q(b)}" for b in LK.MULTI_WORD_BRANDS)
    multi_rest = " ".join(
        f"WHEN starts_with(lower(clean), {q(b.lower())}) THEN {trim_ws(f'substr(clean, {len(b) + 1})')}"
        for b in LK.MULTI_WORD_BRANDS)
    brand_expr = (f"CASE WHEN car_name IS NULL OR car_name = '' THEN 'Unknown' {multi_brand} "
                  f"WHEN canon IS NOT NULL THEN canon WHEN first_word <> '' THEN first_word "
                  f"ELSE 'Unknown' END")
    rest_expr = (f"CASE WHEN car_name IS NULL OR car_name = '' THEN '' {multi_rest} "
                 f"WHEN canon IS NOT NULL THEN {trim_ws('substr(clean, length(first_word) + 1)')} "
                 f"WHEN first_word <> '' THEN regexp_extract(clean, '(?s)^\\s*\\S+\\s+(.*)$', 1) "
                 f"ELSE '' END")
    # Brand-specific patterns.
    bp_model, bp_trim = [], []
    for b, pats in LK.BRAND_MODEL_PATTERNS.items():
        m_w, t_w = [], []
        for p in pats:
            full = "(?is)^(.*?)(?:" + p + ")(.*)$"
            cond = f"regexp_matches(rest, {q('(?i)' + p)})"
            m_w.append(f"WHEN {cond} THEN regexp_extract(rest, {q(full)}, 2)")
            t_w.append(f"WHEN {cond} THEN NULLIF({trim_ws(f'regexp_extract(rest, {q(full)}, 3)')}, '')")
        bp_model.append(f"WHEN brand = {q(b)} THEN CASE {' '.join(m_w)} END")
        bp_trim.append(f"WHEN brand = {q(b)} THEN CASE {' '.join(t_w)} END")
    tok = "regexp_replace(" + trim_ws("rest") + r", '\s+', ' ', 'g')"
    code = r"(?:\d+\.\d+[AM]|A|M)"
    ec_re = r"^(\S+(?: \S+)*?) (" + code + r"(?: .*)?)$"
    first_is_code = f"regexp_matches(regexp_extract({tok}, '^(\\S*)', 1), '^\\d+\\.\\d+[AM]$')"
    kw = "(?:" + "|".join(LK.TRIM_KEYWORDS) + ")"
    kw_prefix = f"regexp_extract(rest, {q('(?is)^(.*?)\\b' + kw + '\\b')}, 1)"
    kw_hit = f"regexp_matches(rest, {q('(?i)\\b' + kw + '\\b')})"
    comm_words = "(?i)\\b(" + "|".join(LK.COMMERCIAL_MODEL_WORDS) + ")\\b"
    a = as_of.isoformat()
    def dmy(c: str) -> str:
        t = trim_ws(c)
        return (f"CASE WHEN regexp_matches({t}, '^\\d{{1,2}}-[A-Za-z]{{3}}-\\d{{4}}$') "
                f"THEN CAST(try_strptime({t}, '%d-%b-%Y') AS DATE) END")

    def iso(c: str) -> str:
        t = trim_ws(c)
        return (f"CASE WHEN regexp_matches({t}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') "
                f"THEN CAST(try_strptime({t}, '%Y-%m-%d') AS DATE) END")

    posted = f"COALESCE({dmy('posted_date')}, {iso('posted_date')})"
    coe_t = trim_ws("coe_remaining")
    coe_total = (f"(COALESCE(TRY_CAST(regexp_extract({coe_t}, '(\\d+)y', 1) AS BIGINT), 0) * 12 "
                 f"+ COALESCE(TRY_CAST(regexp_extract({coe_t}, '(\\d+)m', 1) AS BIGINT), 0))")
    metrics = LK.SCORE_METRICS
    ranks = ",\n      ".join(
        f"CASE WHEN {m} IS NOT NULL THEN percent_rank() OVER (PARTITION BY {m} IS NULL ORDER BY {m}) END AS r_{m}"
        for m, _ in metrics)
    num = "0.0::DOUBLE"
    den = "0.0::DOUBLE"
    for m, w in metrics:
        num = f"({num} + COALESCE((1.0::DOUBLE - r_{m}) * {w}::DOUBLE, 0.0::DOUBLE))"
        den = f"({den} + CASE WHEN r_{m} IS NOT NULL THEN {w}::DOUBLE ELSE 0.0::DOUBLE END)"
    status_map = case_map("status", LK.STATUS_MAP)
    return f"""
silver AS ({silver}),
g_clean AS (
  SELECT s.*, c.clean, regexp_extract(c.clean, '^\\s*(\\S+)', 1) AS first_word
  FROM silver s, LATERAL (SELECT {clean} AS clean) c),
g_brand0 AS (
  SELECT g.*, d.canon FROM g_clean g LEFT JOIN ({brand_dim_sql()}) d ON lower(g.first_word) = d.low),
g_brand AS (
  SELECT *, {brand_expr} AS brand, {rest_expr} AS rest FROM g_brand0),
g_split AS (
  SELECT *,
    CASE {' '.join(bp_model)} END AS bp_model,
    CASE {' '.join(bp_trim)} END AS bp_trim,
    CASE WHEN NOT {first_is_code} AND regexp_matches({tok}, {q(ec_re)})
         THEN regexp_extract({tok}, {q(ec_re)}, 1) END AS ec_model,
    CASE WHEN NOT {first_is_code} AND regexp_matches({tok}, {q(ec_re)})
         THEN regexp_extract({tok}, {q(ec_re)}, 2) END AS ec_trim,
    CASE WHEN {kw_hit} AND {kw_prefix} <> '' THEN NULLIF({trim_ws(kw_prefix)}, '') END AS kw_model,
    CASE WHEN {kw_hit} AND {kw_prefix} <> ''
         THEN NULLIF({trim_ws(f'substr(rest, length({kw_prefix}) + 1)')}, '') END AS kw_trim,
    {kw_hit} AND {kw_prefix} <> '' AS kw_ok
  FROM g_brand),
tagged AS (
  SELECT *,
    CASE WHEN rest = '' THEN NULL WHEN bp_model IS NOT NULL THEN bp_model
         WHEN ec_model IS NOT NULL THEN ec_model WHEN kw_ok THEN kw_model
         ELSE NULLIF(rest, '') END AS model,
    CASE WHEN rest = '' THEN NULL WHEN bp_model IS NOT NULL THEN bp_trim
         WHEN ec_model IS NOT NULL THEN ec_trim WHEN kw_ok THEN kw_trim
         ELSE NULL END AS trim_,
    (COALESCE(vehicle_type IN {in_list(LK.COMMERCIAL_VEHICLE_TYPES)}, false)
     OR COALESCE(brand IN {in_list(LK.COMMERCIAL_BRANDS)}, false)
     OR COALESCE(regexp_matches(car_name, {q(comm_words)}), false)) AS commercial
  FROM g_split),
gold0 AS (
  SELECT
    listing_id, brand, model, trim_ AS "trim", car_name, price, installment, depreciation,
    dereg_value, manufactured,
    CAST(CASE WHEN manufactured <> 0 THEN {as_of.year} - manufactured END AS INTEGER) AS age_years,
    mileage_km, engine_cap_cc, transmission,
    {case_map('fuel_type', LK.FUEL_TYPE_MAP)} AS fuel_type,
    power, curb_weight,
    strftime({dmy('reg_date')}, '%Y-%m-%d') AS reg_date,
    coe,
    CAST(CASE WHEN coe_remaining <> '' AND {coe_total} > 0 THEN {coe_total} END AS INTEGER)
      AS coe_remaining_months,
    road_tax, omv, arf,
    CASE WHEN vehicle_type IN {in_list(LK.COE_CATEGORY_CODES)} THEN NULL
         ELSE {case_map('vehicle_type', LK.VEHICLE_TYPE_MAP)} END AS vehicle_type,
    listing_type, owners,
    CAST(CASE WHEN {posted} IS NOT NULL
         THEN greatest(date_diff('day', {posted}, DATE '{a}'), 0) END AS INTEGER) AS days_on_market,
    features, accessories, detail_url,
    CASE WHEN price <> 0 AND omv > 0 THEN round_even(price / omv, 3) END AS price_to_omv_ratio,
    COALESCE({status_map}, 'Available') AS status,
    strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS first_seen_at,
    strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS last_seen_at
  FROM tagged WHERE NOT commercial),
ranked AS (
  SELECT listing_id,
      {ranks}
  FROM gold0 WHERE status = 'Available'),
scores AS (
  SELECT listing_id,
    CASE WHEN {den} > 0 THEN round_even({num} / {den} * 100.0::DOUBLE, 1) END AS value_score
  FROM ranked),
gold AS (
  SELECT g.listing_id, brand, model, "trim", car_name, price, installment, depreciation,
    dereg_value, manufactured, age_years, mileage_km, engine_cap_cc, transmission, fuel_type,
    power, curb_weight, reg_date, coe, coe_remaining_months, road_tax, omv, arf, vehicle_type,
    listing_type, owners, days_on_market, features, accessories, detail_url,
    price_to_omv_ratio, s.value_score, status, first_seen_at, last_seen_at
  FROM gold0 g LEFT JOIN scores s ON g.listing_id = s.listing_id)"""


def gold_sql(as_of=TEST_AS_OF) -> str:
    return f"WITH {gold_ctes(as_of)}\nSELECT * FROM gold"


def stats_sql() -> str:
    return f"""WITH {gold_ctes()}
SELECT count(*) AS total_silver,
       count(*) FILTER (WHERE commercial) AS excluded_commercial,
       count(*) FILTER (WHERE NOT commercial) AS gold_rows,
       count(*) FILTER (WHERE NOT commercial AND COALESCE({case_map('status', LK.STATUS_MAP)}, 'Available') = 'Available') AS available,
       count(*) FILTER (WHERE NOT commercial AND COALESCE({case_map('status', LK.STATUS_MAP)}, 'Available') = 'Sold') AS sold
FROM tagged"""


def value_score_sql() -> str:
    return f"WITH {gold_ctes()}\nSELECT listing_id, value_score FROM scores"
