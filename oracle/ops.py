"""DuckDB oracles of the quality, stats, lifecycle, merge and SCD queries."""

from __future__ import annotations

from lotwright.functions import lookups as LK
from lotwright.operators import quality as Q
from lotwright.schemas import LISTING_COLUMNS, LISTING_TYPES

from .gold import gold_ctes
from .views import feed_sql, q, silver_sql

SILVER = f"WITH silver AS ({silver_sql()})\n"
FEED = f"WITH feed AS ({feed_sql()})\n"
TS = "'%Y-%m-%d %H:%M:%S'"
RUN_TS = "TIMESTAMP '2002-07-01 06:00:00'"
FEED_COLS = ["price", "depreciation", "status", "detail_url", "owners"]
FEED_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def reason_sql(rule: Q.Rule) -> str | None:
    c = rule.column
    if rule.kind == "range":
        lo, hi = rule.args
        nan = f" AND NOT isnan({c})" if c == "power" else ""
        return (f"CASE WHEN {c} IS NOT NULL AND NOT ({c} BETWEEN {lo} AND {hi}){nan} "
                f"THEN '{c}: ' || CAST({c} AS VARCHAR) || ' outside range [{lo}, {hi}]' END")
    if rule.kind == "enum":
        listing = "[" + ", ".join(f"''{v}''" for v in sorted(rule.args)) + "]"
        return (f"CASE WHEN {c} IS NOT NULL AND {c} NOT IN {in_list(rule.args)} "
                f"THEN '{c}: ''' || {c} || ''' not in {listing}' END")
    if rule.kind == "regex":
        return (f"CASE WHEN {c} IS NOT NULL AND NOT regexp_matches({c}, {q(rule.args[0])}) "
                f"THEN '{c}: ''' || {c} || ''' does not match pattern' END")
    if rule.kind == "prefix":
        p = rule.args[0]
        return (f"CASE WHEN {c} IS NOT NULL AND NOT starts_with({c}, {q(p)}) "
                f"THEN '{c}: ''' || {c} || ''' does not start with ''{p}''' END")
    return None


def _checked():
    rules = [(r, reason_sql(r)) for r in Q.RULES if reason_sql(r) is not None]
    reasons = ",\n  ".join(f"{x} AS _r_{r.column}" for r, x in rules)
    return rules, f"checked AS (SELECT *, {reasons} FROM silver)"


def validate_clean_sql() -> str:
    rules, checked = _checked()
    ruled = {r.column for r, _ in rules}
    cols = [f"CASE WHEN _r_{c} IS NULL THEN {c} END AS {c}" if c in ruled else c
            for c in LISTING_COLUMNS]
    return (SILVER + f", {checked}\nSELECT {', '.join(cols)}, "
            f"strftime(scraped_at, {TS}) AS scraped_at FROM checked")


def failures_cte() -> str:
    rules, checked = _checked()
    parts = [f"SELECT listing_id, '{r.column}' AS field_name, CAST({r.column} AS VARCHAR) AS field_value, "
             f"'{r.name}' AS rule_name, _r_{r.column} AS reason FROM checked WHERE _r_{r.column} IS NOT NULL"
             for r, _ in rules]
    return f"{checked}, failures AS ({' UNION ALL '.join(parts)})"


def validate_failures_sql() -> str:
    return SILVER + f", {failures_cte()}\nSELECT * FROM failures"


def quarantine_sql(select: str) -> str:
    return (SILVER + f", {failures_cte()}, quarantine AS (SELECT *, NULL::VARCHAR AS raw_record, "
            f"{RUN_TS} AS quarantined_at, 1::BIGINT AS scrape_run_id, false AS resolved FROM failures)\n"
            + select)


def coverage_sql() -> str:
    parts = [f"SELECT '{c}' AS field_name, count({c}) AS non_null, count(*) AS total FROM silver"
             for c in LISTING_COLUMNS]
    return (SILVER + f", cov AS ({' UNION ALL '.join(parts)})\n"
            "SELECT field_name, non_null, total, CASE WHEN total > 0 THEN "
            "round_even(CAST(non_null AS DOUBLE) * 100.0::DOUBLE / total, 1) END AS pct FROM cov")


def profile_counts_sql() -> str:
    dims = ["brand", "fuel_type", "vehicle_type", "status", "listing_type"]
    parts = [f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value FROM gold" for d in dims]
    return (f"WITH {gold_ctes()}, u AS ({' UNION ALL '.join(parts)})\n"
            "SELECT dimension, value, count(*) AS n FROM u GROUP BY dimension, value")


def profile_numeric_sql() -> str:
    cols = ["price", "depreciation", "mileage_km", "age_years", "coe_remaining_months",
            "price_to_omv_ratio", "value_score"]
    aggs = ["count(*) AS rows", "count(DISTINCT brand) AS distinct_brands",
            "count(DISTINCT (brand, model)) FILTER (WHERE brand IS NOT NULL AND model IS NOT NULL) AS distinct_models"]
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        aggs += [f"min({x}) AS {c}_min", f"max({x}) AS {c}_max",
                 f"round_even(avg({x}), 2) AS {c}_avg", f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls"]
    return f"WITH {gold_ctes()}\nSELECT {', '.join(aggs)} FROM gold"


MISSING = "detail_url IS NOT NULL AND (price IS NULL OR accessories IS NULL)"
ACTIVE = (f"detail_url IS NOT NULL AND price IS NOT NULL AND accessories IS NOT NULL AND "
          f"(status IS NULL OR status NOT IN {in_list(LK.INACTIVE_STATUSES)})")


def collapse(group: list[str], extra: str = "") -> str:
    g = ", ".join(group)
    cols = ", ".join(f"arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in FEED_COLS)
    return f"SELECT {g}, {cols}, max(seq) AS seq{extra} FROM feed GROUP BY {g}"


DAILY = ("day", "CAST(day AS TIMESTAMP) + INTERVAL 1 DAY", "CAST(strftime(day, '%Y%m%d') AS BIGINT)")
WEEKLY = ("batch", "TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(7 * (batch + 1) AS INT))", "batch")


def replay_cte(batches: tuple[str, str, str] = DAILY) -> str:
    batch, run_ts, run_id = batches
    prev = ", ".join(
        f"last_value({f} IGNORE NULLS) OVER w AS _prev_{f}" for f in LK.SCD_TRACKED_FIELDS)
    change = " OR ".join(
        f"({f} IS NOT NULL AND (_prev_{f} IS NULL OR _prev_{f} <> {f}))" for f in LK.SCD_TRACKED_FIELDS)
    return f"""b AS ({collapse(['listing_id', batch], ', count(*) AS _rows')}),
p AS (SELECT *, {prev}, count(*) OVER w AS _n_before FROM b
      WINDOW w AS (PARTITION BY listing_id ORDER BY {batch} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
replayed AS (SELECT *, CASE WHEN _n_before = 0 THEN 'new' WHEN {change} THEN 'changed' ELSE 'unchanged' END AS _action,
      {run_ts} AS valid_from, {run_id} AS scrape_run_id FROM p),
h0 AS (SELECT * FROM replayed WHERE _action IN ('new', 'changed')),
history AS (SELECT *, lead(valid_from) OVER (PARTITION BY listing_id ORDER BY valid_from) AS valid_to FROM h0)"""


HIST_SELECT = (f"SELECT listing_id, {', '.join(FEED_COLS)}, strftime(valid_from, {TS}) AS valid_from, "
               f"strftime(valid_to, {TS}) AS valid_to, valid_to IS NULL AS is_current, scrape_run_id FROM history")


def oracles() -> dict[str, str]:
    o = {}
    o["brand_model_trim"] = f"WITH {gold_ctes()}\nSELECT listing_id, brand, model, trim_ AS \"trim\" FROM tagged"
    o["commercial_filter"] = (f"WITH {gold_ctes()}\nSELECT listing_id, commercial FROM tagged "
                              f"UNION ALL SELECT listing_id, true FROM silver WHERE listing_id NOT IN "
                              f"(SELECT listing_id FROM tagged)")
    o["validate_clean"] = validate_clean_sql()
    o["validate_failures"] = validate_failures_sql()
    o["quarantine_stats"] = quarantine_sql(
        "SELECT count(*) AS total, count(*) FILTER (WHERE NOT COALESCE(resolved, false)) AS unresolved FROM quarantine")
    o["quarantine_by_rule"] = quarantine_sql(
        "SELECT rule_name, count(*) AS cnt FROM quarantine GROUP BY rule_name ORDER BY cnt DESC, rule_name")
    o["quarantine_recent"] = quarantine_sql(
        "SELECT listing_id, field_name, field_value, rule_name, reason, raw_record, "
        f"strftime(quarantined_at, {TS}) AS quarantined_at, scrape_run_id, resolved FROM quarantine "
        "ORDER BY quarantined_at DESC, listing_id DESC, field_name LIMIT 50")
    o["listing_counts"] = SILVER + ("SELECT count(*) AS total, count(*) FILTER (WHERE price IS NULL "
                                    "AND detail_url IS NOT NULL) AS missing_details FROM silver")
    o["field_coverage"] = coverage_sql()
    o["price_stats"] = SILVER + ("SELECT * FROM (SELECT count(*) AS count, min(price) AS min, max(price) AS max, "
                                 "CAST(trunc(avg(price)) AS BIGINT) AS mean FROM silver WHERE price IS NOT NULL) "
                                 "WHERE count > 0")
    o["profile_counts"] = profile_counts_sql()
    o["profile_numeric"] = profile_numeric_sql()
    o["worklist_missing"] = SILVER + f"SELECT listing_id, detail_url FROM silver WHERE {MISSING} ORDER BY listing_id"
    o["worklist_active"] = SILVER + f"SELECT listing_id, detail_url FROM silver WHERE {ACTIVE} ORDER BY listing_id"
    o["worklist_union"] = SILVER + (
        f"SELECT listing_id, detail_url, CASE WHEN {MISSING} THEN 0 ELSE 1 END AS priority FROM silver "
        f"WHERE ({MISSING}) OR ({ACTIVE}) ORDER BY priority, listing_id")
    o["worklist_fetch_urls"] = SILVER + (
        "SELECT listing_id, CASE WHEN starts_with(detail_url, 'http') THEN detail_url "
        "ELSE 'https://www.example.com' || detail_url END AS url, "
        f"CASE WHEN {MISSING} THEN 0 ELSE 1 END AS priority FROM silver "
        f"WHERE ({MISSING}) OR ({ACTIVE}) ORDER BY priority, listing_id")
    o["new_only"] = SILVER + (
        "SELECT DISTINCT l_orderkey AS listing_id FROM lineitem WHERE l_orderkey NOT IN "
        "(SELECT listing_id FROM silver WHERE scraped_at < TIMESTAMP '1998-01-01 00:00:00')")
    o["delist_unseen"] = SILVER + (
        "SELECT listing_id, CASE WHEN d THEN 'Delisted' ELSE status END AS status, d AS delisted FROM ("
        "SELECT listing_id, status, COALESCE(listing_id NOT IN (SELECT l_orderkey FROM lineitem) "
        f"AND status <> 'Delisted' AND status IN {in_list(LK.DELISTABLE_STATUSES)}, false) AS d FROM silver)")
    o["batch_last_nonnull"] = FEED + (
        f"SELECT listing_id, strftime(day, '%Y-%m-%d') AS day, {', '.join(FEED_COLS)}, seq FROM ("
        + collapse(["listing_id", "day"]) + ")")
    upd = ", ".join(f"COALESCE(i.{c}, s.{c}) AS {c}" for c in FEED_COLS)
    o["upsert_coalesce"] = (
        f"WITH silver AS ({silver_sql()}), feed AS ({feed_sql()}), inc AS ({collapse(['listing_id'])})\n"
        f"SELECT COALESCE(s.listing_id, i.listing_id) AS listing_id, {upd}, "
        f"strftime(COALESCE(s.scraped_at, {RUN_TS}), {TS}) AS scraped_at "
        "FROM silver s FULL OUTER JOIN inc i ON s.listing_id = i.listing_id")
    rp = f"WITH feed AS ({feed_sql()}), {replay_cte()}\n"
    o["scd2_history"] = rp + HIST_SELECT
    o["scd2_counts"] = rp + ("SELECT strftime(day, '%Y-%m-%d') AS day, count(*) FILTER (WHERE _action = 'new') AS new, "
                             "count(*) FILTER (WHERE _action = 'changed') AS changed, "
                             "count(*) FILTER (WHERE _action = 'unchanged') AS unchanged, CAST(sum(_rows) AS BIGINT) AS total "
                             "FROM replayed GROUP BY day")
    o["scd2_versions"] = (f"WITH feed AS ({feed_sql()}), {replay_cte()}, state AS ({collapse(['listing_id'])}), "
                          "v AS (SELECT listing_id, count(*) AS versions FROM history GROUP BY listing_id)\n"
                          "SELECT s.listing_id, s.price, v.versions FROM state s JOIN v ON s.listing_id = v.listing_id "
                          "WHERE v.versions >= 2 ORDER BY versions DESC, listing_id")
    o["recent_changes"] = rp + HIST_SELECT + (f" WHERE valid_from >= {FEED_AS_OF} - INTERVAL 72 HOURS "
                                              "ORDER BY valid_from DESC, listing_id")
    o["current_rows"] = rp + HIST_SELECT + " WHERE valid_to IS NULL"
    o["scd2_apply_history"] = (
        f"WITH {valid_feed('day_feed')}, feed AS (SELECT *, CAST(floor(date_diff('day', DATE '2024-01-01', day) / 7) "
        f"AS BIGINT) AS batch FROM day_feed), {replay_cte(WEEKLY)}\n" + HIST_SELECT)
    o["integrity_violations"] = (
        f"WITH {gold_ctes()}, feed AS ({feed_sql()}), {replay_cte()}, "
        "g0 AS (SELECT listing_id, CASE WHEN listing_id % 701 <> 0 THEN brand END AS brand, "
        "CASE WHEN listing_id % 901 = 0 THEN 'Lost' ELSE status END AS status FROM gold), "
        "g AS (SELECT * FROM g0 UNION ALL SELECT * FROM g0 WHERE listing_id % 501 = 0), "
        "r AS (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY valid_from) AS rk FROM history), "
        "h AS (SELECT listing_id, valid_from, valid_to, valid_to IS NULL OR listing_id % 7 = 0 AS cur FROM r "
        "WHERE listing_id % 11 <> 0 OR rk <> 2)\n"
        "SELECT 'duplicate_key' AS \"check\", listing_id FROM g GROUP BY listing_id HAVING count(*) > 1 "
        "UNION ALL SELECT CASE WHEN brand IS NULL THEN 'null_brand' ELSE 'status_not_allowed' END, listing_id FROM g "
        f"WHERE brand IS NULL OR status IS NULL OR status NOT IN {in_list(LK.GOLD_STATUS_VALUES)} "
        "UNION ALL SELECT 'multiple_current', listing_id FROM h WHERE cur GROUP BY listing_id HAVING count(*) > 1 "
        "UNION ALL SELECT DISTINCT 'orphan_history', listing_id FROM h WHERE listing_id % 13 = 0 "
        "UNION ALL SELECT 'broken_chain', listing_id FROM h WHERE valid_to IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM h s WHERE s.listing_id = h.listing_id AND s.valid_from = h.valid_to)")
    cast = "CAST({} AS VARCHAR)"
    o["change_details"] = (
        f"WITH silver AS ({silver_sql()}), feed AS ({feed_sql()}), inc AS ({collapse(['listing_id'])}) " + " UNION ALL ".join(
            f"SELECT i.listing_id, '{c}' AS field, {cast.format('s.' + c)} AS old_value, {cast.format('i.' + c)} AS new_value "
            f"FROM inc i JOIN silver s USING (listing_id) WHERE i.{c} IS NOT NULL AND (s.{c} IS NULL OR s.{c} <> i.{c})"
            for c in ("price", "depreciation", "status")))
    o["worklist_limited"] = o["worklist_union"] + " LIMIT 500"
    o["record_validity"] = (SILVER + f", {_checked()[1]}\nSELECT listing_id, "
                            + " AND ".join(f"_r_{r.column} IS NULL" for r, _ in _checked()[0]) + " AS is_valid FROM checked")
    o["history_slice"] = rp + (
        f"SELECT listing_id, CAST(row_number() OVER (ORDER BY valid_from) AS INT) AS version, {', '.join(FEED_COLS)}, "
        f"strftime(valid_from, {TS}) AS valid_from FROM history WHERE listing_id = (SELECT min(listing_id) FROM history) "
        "ORDER BY version LIMIT 5")
    return o


def ledger_oracles() -> dict[str, str]:
    runs = (f"WITH feed AS ({feed_sql()}), d AS (SELECT day, CAST(strftime(day, '%Y%m%d') AS BIGINT) AS run_id, min(ts) AS a, "
            "max(ts) AS b, CAST(count(*) AS INT) AS n, CAST(count(DISTINCT listing_id) AS INT) AS k, "
            "day < DATE '2024-01-30' AS done FROM feed GROUP BY day)\n")
    cols = ", ".join(LISTING_COLUMNS)
    rules, checked = _checked()
    ruled = {r.column for r, _ in rules}
    clean = ", ".join(f"CASE WHEN _r_{c} IS NULL THEN {c} END AS {c}" if c in ruled else c for c in LISTING_COLUMNS)
    coverage = " UNION ALL ".join(f"SELECT 'coverage.{c}' AS metric, CAST(count({c}) AS DOUBLE) AS value FROM silver"
                                  for c in LISTING_COLUMNS)
    price = " UNION ALL ".join(
        f"SELECT 'price.{n}', CAST({x} AS DOUBLE) FROM silver WHERE price IS NOT NULL HAVING count(*) > 0" for n, x in
        (("count", "count(*)"), ("min", "min(price)"), ("max", "max(price)"), ("mean", "trunc(avg(price))")))
    return {
        "export_listings": SILVER + f"SELECT {cols} FROM silver",
        "ingest_listings": SILVER + f", {checked}, c AS (SELECT {clean} FROM checked)\nSELECT * FROM c WHERE listing_id IS NOT NULL",
        "run_states": runs + f"SELECT run_id, strftime(a, {TS}) AS started_at, CASE WHEN done THEN strftime(b, {TS}) END AS "
                      "finished_at, CASE WHEN done THEN n END AS pages_fetched, CASE WHEN done THEN k END AS listings_count, "
                      "CASE WHEN done THEN 'completed' ELSE 'running' END AS status FROM d",
        "last_run": runs + "SELECT run_id, CASE WHEN done THEN n END AS pages_fetched, "
                    "CASE WHEN done THEN 'completed' ELSE 'running' END AS status FROM d ORDER BY run_id DESC LIMIT 1",
        "resume_page": runs + "SELECT n + 1 AS resume_page FROM d WHERE done ORDER BY run_id DESC LIMIT 1",
        "stats_report": SILVER + f"{coverage} UNION ALL {price}",
    }


def valid_feed(name: str = "feed") -> str:
    """CTEs of the feed as the step leaves it: values that break a rule blanked, rows without a key gone."""
    rules = [(r, reason_sql(r)) for r in Q.RULES if r.column in ("listing_id", *FEED_COLS) and reason_sql(r) is not None]
    why = {r.column: x for r, x in rules}
    clean = ", ".join(f"CASE WHEN ({why[c]}) IS NULL THEN {c} END AS {c}" if c in why else c
                      for c in ("listing_id", *FEED_COLS))
    bad = " UNION ALL ".join(
        f"SELECT listing_id, '{r.column}' AS field_name, CAST({r.column} AS VARCHAR) AS field_value, '{r.name}' AS rule_name, "
        f"({x}) AS reason, day FROM raw WHERE ({x}) IS NOT NULL" for r, x in rules)
    return (f"raw AS ({feed_sql()}), bad AS ({bad}), "
            f"{name} AS (SELECT * FROM (SELECT {clean}, seq, ts, day FROM raw) WHERE listing_id IS NOT NULL)")


def stream_oracles() -> dict[str, str]:
    batch = "CAST((dense_rank() OVER (ORDER BY day) - 1) // 3 AS BIGINT)"
    three = ("batch", "CAST(last_day AS TIMESTAMP) + INTERVAL 1 DAY", "1000000 + batch")
    ids = f"SELECT *, row_number() OVER (ORDER BY batch, listing_id, field_name, field_value, reason) AS quarantine_id FROM n"
    days = f"days AS (SELECT day, batch, max(day) OVER (PARTITION BY batch) AS last_day FROM (SELECT day, {batch} AS batch FROM (SELECT DISTINCT day FROM raw)))"
    replay = replay_cte(three).replace("FROM p),", "FROM p JOIN (SELECT DISTINCT batch, last_day FROM days) USING (batch)),")
    return {
        "stream_ingest": f"WITH {valid_feed()} SELECT listing_id, " + ", ".join(FEED_COLS)
                         + " FROM (" + collapse(["listing_id"]) + ")",
        "stream_history": (f"WITH {valid_feed('feed0')}, {days}, "
                           f"feed AS (SELECT feed0.*, batch FROM feed0 JOIN days USING (day)), {replay}\n" + HIST_SELECT),
        "stream_quarantine": (f"WITH {valid_feed()}, {days}, n AS (SELECT bad.*, batch, last_day FROM bad JOIN days USING (day)), "
                              f"i AS ({ids}) SELECT quarantine_id, listing_id, field_name, field_value, rule_name, reason, "
                              f"strftime(CAST(last_day AS TIMESTAMP) + INTERVAL 1 DAY, {TS}) AS quarantined_at, "
                              "1000000 + batch AS scrape_run_id, false AS resolved FROM i"),
        "stream_discovery": ("SELECT o_orderkey AS listing_id, '/used-cars/info/car-' || o_orderkey AS detail_url FROM orders"),
    }


def daily_sql(preload: str, detail: str) -> str:
    """Counts of the daily run's phases: discovery on the stored listings, details of the entries whose page
    was fetched (only URLs of ``orders`` pages are), a phase that fails, gold over the result."""
    rules = [(r, reason_sql(r)) for r in Q.RULES if reason_sql(r) is not None]
    failures = " + ".join(f"count(*) FILTER (WHERE ({x}) IS NOT NULL)" for _, x in rules)
    why = {r.column: x for r, x in rules}
    types = {f: t.simpleString() for f, t in LISTING_TYPES.items()}
    fit = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    clean = ", ".join(f"TRY_CAST(CASE WHEN ({why[c]}) IS NULL THEN {c} END AS {fit[types[c]]}) AS {c}" if c in why
                      else f"{c}" for c in LISTING_COLUMNS)
    changed = " OR ".join(f"(c.{f} IS NOT NULL AND (b.{f} IS NULL OR b.{f} <> c.{f}))" for f in LK.SCD_TRACKED_FIELDS)
    merged = ", ".join("b.listing_id" if c == "listing_id" else f"COALESCE(c.{c}, b.{c}) AS {c}" for c in LISTING_COLUMNS)
    detail = detail.replace("silver AS", "silver0 AS").replace("FROM silver ", "FROM crawled ").replace(
        "work AS (", "work AS (SELECT * FROM (").replace("), detail AS", ") WHERE k < 50000000 AND (k % 3 <> 0)), detail AS")
    detail = detail[detail.index("work AS"):]
    commercial = gold_ctes(silver_cte="SELECT * FROM after").split("silver AS", 1)[1]
    return (
        f"WITH {preload.replace('silver AS', 'silver1 AS', 1).replace('FROM silver ', 'FROM silver1 ')}, "
        "crawled AS (SELECT s.* REPLACE (CASE WHEN g.listing_id IS NOT NULL THEN 'Delisted' ELSE s.status END AS status) "
        "FROM stored s LEFT JOIN gone g USING (listing_id) UNION ALL BY NAME SELECT listing_id, detail_url, "
        f"{RUN_TS} AS scraped_at FROM new), pending AS (SELECT count(*) AS n FROM crawled WHERE ({MISSING}) OR ({ACTIVE})), "
        f"{detail}, c AS (SELECT {clean} FROM detail), "
        f"d AS (SELECT count(*) AS total, {failures} AS quarantined FROM detail), "
        f"act AS (SELECT {changed} AS changed FROM c JOIN crawled b ON b.listing_id = c.listing_id), "
        f"after AS (SELECT {merged}, b.scraped_at FROM crawled b LEFT JOIN c ON c.listing_id = b.listing_id), "
        f"silver AS{commercial}, m AS ("
        "SELECT 0 AS phase_no, 'discover' AS phase, 'found' AS metric, (SELECT count(*) FROM found) AS value "
        "UNION ALL SELECT 0, 'discover', 'new', (SELECT count(*) FROM new) UNION ALL SELECT 0, 'discover', 'delisted', (SELECT count(*) FROM gone) "
        "UNION ALL SELECT 1, 'details', 'pending', (SELECT n FROM pending) UNION ALL SELECT 1, 'details', 'total', (SELECT total FROM d) "
        "UNION ALL SELECT 1, 'details', 'quarantined', (SELECT quarantined FROM d) UNION ALL SELECT 1, 'details', 'new', 0 "
        "UNION ALL SELECT 1, 'details', 'changed', (SELECT count(*) FROM act WHERE changed) "
        "UNION ALL SELECT 1, 'details', 'unchanged', (SELECT count(*) FROM act WHERE NOT COALESCE(changed, false)) "
        "UNION ALL SELECT 2, 'export', NULL, NULL "
        "UNION ALL SELECT 3, 'gold', 'total_silver', (SELECT count(*) FROM after) UNION ALL SELECT 3, 'gold', 'gold_rows', (SELECT count(*) FROM gold) "
        "UNION ALL SELECT 3, 'gold', 'excluded_commercial', (SELECT count(*) FROM after) - (SELECT count(*) FROM gold) "
        "UNION ALL SELECT 3, 'gold', 'available', (SELECT count(*) FROM gold WHERE status = 'Available') "
        "UNION ALL SELECT 3, 'gold', 'sold', (SELECT count(*) FROM gold WHERE status = 'Sold')) "
        "SELECT CAST(phase_no AS INT) AS phase_no, phase, CASE WHEN metric IS NULL THEN 'failed' ELSE 'completed' END AS status, "
        "CASE WHEN metric IS NULL THEN 'RuntimeError: no connection' END AS error, metric, CAST(value AS BIGINT) AS value, "
        "'failed' AS run_status FROM m")


def pipeline_oracles() -> dict[str, str]:
    """Quarantine life, mixed schemas, discovery, daily run."""
    from .pages import detail_sql
    old = LISTING_COLUMNS[:14]
    mixed = ", ".join(c if c in old else f"CASE WHEN listing_id % 2 <> 0 THEN {c} END AS {c}" for c in LISTING_COLUMNS)
    preload = (f"silver AS ({silver_sql()}), stored AS (SELECT * FROM silver WHERE listing_id % 3 <> 0 UNION ALL "
               "SELECT * REPLACE (listing_id + 50000000 AS listing_id, '/used-cars/info/gone-' || (listing_id + 50000000) AS detail_url) "
               "FROM silver WHERE listing_id % 50 = 0), "
               "found AS (SELECT o_orderkey AS listing_id, '/used-cars/info/car-' || o_orderkey AS detail_url FROM orders), "
               "new AS (SELECT * FROM found WHERE listing_id NOT IN (SELECT listing_id FROM stored)), "
               "gone AS (SELECT listing_id FROM stored WHERE listing_id NOT IN (SELECT listing_id FROM found) "
               f"AND status <> 'Delisted' AND status IN {in_list(LK.DELISTABLE_STATUSES)})")
    return {
        "quarantine_resolved": quarantine_sql(
            "SELECT row_number() OVER (ORDER BY listing_id % 2 DESC, listing_id, field_name, field_value, reason) AS quarantine_id, "
            "listing_id, field_name, field_value, rule_name, reason, CASE WHEN listing_id % 2 = 1 THEN 1 ELSE 2 END AS scrape_run_id, "
            "rule_name = 'fuel_type_enum' AS resolved FROM quarantine"),
        "schema_migration": SILVER + f"SELECT {mixed} FROM silver",
        "daily_run": daily_sql(preload, detail_sql()),
        "discover_listings": (
            f"WITH {preload} SELECT s.listing_id, s.detail_url, CASE WHEN g.listing_id IS NOT NULL THEN 'Delisted' ELSE s.status END "
            f"AS status, s.price, strftime(s.scraped_at, {TS}) AS scraped_at FROM stored s LEFT JOIN gone g USING (listing_id) "
            f"UNION ALL SELECT listing_id, detail_url, NULL, NULL, strftime({RUN_TS}, {TS}) FROM new"),
    }
