"""DuckDB oracles of the generic page-shape queries."""

from __future__ import annotations

from lotwright.sources import pages as PG

from lotwright.schemas import LISTING_COLUMNS

from .views import q, silver_sql


def oracles() -> dict[str, str]:
    t, h, s, c = q(PG.TITLE_REGEX), q(PG.HREF_REGEX), q(PG.SCRIPT_REGEX), q(PG.RSC_CHUNK_REGEX)
    return {
        "page_titles": (f"SELECT page_id, CASE WHEN regexp_matches(html, {t}) "
                        f"THEN regexp_extract(html, {t}, 1) END AS title FROM pages"),
        "page_links_first": f"""WITH m AS (SELECT page_id, regexp_extract_all(html, {h}, 1) AS m FROM pages),
l AS (SELECT page_id, unnest(m) AS href, unnest(range(0, len(m))) AS pos FROM m),
r AS (SELECT *, row_number() OVER (PARTITION BY href ORDER BY page_id, pos) AS rn,
             count(*) OVER (PARTITION BY href) AS occurrences FROM l)
SELECT href, page_id, CAST(pos AS INTEGER) AS pos, occurrences FROM r WHERE rn = 1""",
        "page_scripts": (f"SELECT page_id, CAST(len(regexp_extract_all(html, {s}, 1)) AS INTEGER) AS n_scripts, "
                         f"regexp_extract_all(html, {s}, 1)[1] AS first_script, "
                         f"CAST(len(regexp_extract_all(html, {c}, 1)) AS INTEGER) AS n_chunks FROM pages"),
    }


def detail_sql() -> str:
    """The detail records straight from the keys the pages are made of: no
    parsing, so a misread pattern shows."""
    has = "k % 7 <> 0"
    priced = f"{has} AND k % 5 <> 0"
    cols = {c: "NULL" for c in LISTING_COLUMNS}
    model = f"CASE WHEN {has} THEN CASE WHEN k % 4 = 0 THEN 'Title ' || k ELSE 'Model ' || k END END"
    cols.update({
        "listing_id": "k", "detail_url": "detail_url", "car_name": model, "car_model": model,
        "price": f"CASE WHEN {priced} THEN k * 10 + 1 END",
        "depreciation": f"CASE WHEN {priced} AND k % 8 <> 0 THEN k END",
        "road_tax": f"CASE WHEN {has} THEN k % 900 END",
        "features": f"CASE WHEN {has} THEN 'Rims 19\" ' || k END",
        "mileage_km": f"CASE WHEN {has} THEN k * 3 END",
        "engine_cap_cc": f"CASE WHEN {has} THEN CASE WHEN k % 97 = 0 THEN 15982000000000 ELSE k END END",
        "vehicle_type": f"CASE WHEN {has} THEN CASE WHEN k % 6 = 0 THEN 'SUV' WHEN k % 3 = 0 THEN '$15f' ELSE 'Sedan' END END",
        "owners": f"CASE WHEN {has} THEN k % 6 END",
        "accessories": f"CASE WHEN {has} THEN 'Kit ' || k END",
        "coe_remaining": f"CASE WHEN {has} THEN CASE WHEN k % 10 = 0 THEN '10y (renewed)' "
                         "ELSE (k % 9) || 'y ' || (k % 12) || 'm' END END",
        "power": f"CASE WHEN {has} THEN (k % 300) + 0.5::DOUBLE END",
        "listing_type": f"CASE WHEN {has} THEN CASE WHEN k % 2 = 0 THEN 'Direct Owner' ELSE 'Dealer' END END",
        "status": f"CASE WHEN {has} THEN 'Available for sale' END",
    })
    from .ops import ACTIVE, MISSING
    return (f"silver AS ({silver_sql()}), work AS (SELECT listing_id AS k, detail_url FROM silver "
            f"WHERE ({MISSING}) OR ({ACTIVE})), detail AS (SELECT "
            + ", ".join(f"{v} AS {c}" for c, v in cols.items()) + " FROM work)")


def payload_oracles() -> dict[str, str]:
    from .ops import reason_sql
    from lotwright.operators import quality as Q
    rules = [(r, reason_sql(r)) for r in Q.RULES if reason_sql(r) is not None]
    failures = " UNION ALL ".join(
        f"SELECT listing_id, '{r.column}' AS field_name, CAST({r.column} AS VARCHAR) AS field_value, "
        f"'{r.name}' AS rule_name, {x} AS reason FROM detail WHERE ({x}) IS NOT NULL" for r, x in rules)
    return {
        "rsc_detail": f"WITH {detail_sql()} SELECT * FROM detail",
        "detail_quarantine": f"WITH {detail_sql()} {failures}",
        "rsc_listing_links": "SELECT o_orderkey AS listing_id, '/used-cars/info/car-' || o_orderkey AS detail_url FROM orders",
    }
