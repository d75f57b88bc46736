"""Table schemas of the medallion layers (silver, history, quarantine, runs, gold)."""

from __future__ import annotations

from pyspark.sql import types as T

L, I, D, S, TS, B = (T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(),
                     T.TimestampType(), T.BooleanType())

# The 28 silver listing columns in their declared order.
LISTING_FIELDS: list[tuple[str, T.DataType]] = [
    ("listing_id", L), ("car_name", S), ("detail_url", S), ("listing_type", S),
    ("price", L), ("installment", L), ("depreciation", L), ("reg_date", S),
    ("coe_remaining", S), ("mileage_km", L), ("engine_cap_cc", I),
    ("owners", I), ("fuel_type", S), ("posted_date", S),
    ("car_model", S), ("coe", L), ("road_tax", L), ("omv", L), ("arf", L), ("power", D),
    ("transmission", S), ("manufactured", I), ("dereg_value", L), ("curb_weight", I),
    ("status", S), ("features", S), ("accessories", S), ("vehicle_type", S),
]
LISTING_COLUMNS = [n for n, _ in LISTING_FIELDS]
LISTING_TYPES = dict(LISTING_FIELDS)

LISTINGS = T.StructType([T.StructField(n, t) for n, t in LISTING_FIELDS]
                        + [T.StructField("scraped_at", TS)])

HISTORY = T.StructType([T.StructField(n, t) for n, t in LISTING_FIELDS] + [
    T.StructField("valid_from", TS, nullable=False),
    T.StructField("valid_to", TS),
    T.StructField("is_current", B, nullable=False),
    T.StructField("scrape_run_id", L),
])
HISTORY_COLUMNS = [f.name for f in HISTORY.fields]

QUARANTINE = T.StructType([
    T.StructField("quarantine_id", L), T.StructField("listing_id", L), T.StructField("field_name", S, False),
    T.StructField("field_value", S), T.StructField("rule_name", S, False),
    T.StructField("reason", S, False), T.StructField("raw_record", S),
    T.StructField("quarantined_at", TS), T.StructField("scrape_run_id", L),
    T.StructField("resolved", B),
])

# A quarantine row's life is append-only too: one event per change of ``resolved``.
QUARANTINE_EVENTS = T.StructType([
    T.StructField("quarantine_id", L), T.StructField("event_ts", TS), T.StructField("resolved", B),
])

# Outcome of a run's phases.
PHASES = T.StructType([
    T.StructField("phase_no", I, False), T.StructField("phase", S, False), T.StructField("status", S, False),
    T.StructField("error", S), T.StructField("counts", T.MapType(S, L), False),
])

# Run ledger is append-only: one event row per state change of a run.
RUN_EVENTS = T.StructType([
    T.StructField("run_id", L, False), T.StructField("event_ts", TS, False),
    T.StructField("started_at", TS), T.StructField("finished_at", TS),
    T.StructField("pages_fetched", I), T.StructField("listings_count", I),
    T.StructField("status", S),
])

# The 35 gold columns in contract order.
GOLD_FIELDS: list[tuple[str, T.DataType]] = [
    ("listing_id", L), ("brand", S), ("model", S), ("trim", S), ("car_name", S),
    ("price", L), ("installment", L), ("depreciation", L), ("dereg_value", L),
    ("manufactured", I), ("age_years", I), ("mileage_km", L), ("engine_cap_cc", I),
    ("transmission", S), ("fuel_type", S), ("power", D), ("curb_weight", I),
    ("reg_date", S), ("coe", L), ("coe_remaining_months", I), ("road_tax", L),
    ("omv", L), ("arf", L), ("vehicle_type", S), ("listing_type", S), ("owners", I),
    ("days_on_market", I), ("features", S), ("accessories", S), ("detail_url", S),
    ("price_to_omv_ratio", D), ("value_score", D), ("status", S),
    ("first_seen_at", S), ("last_seen_at", S),
]
GOLD_COLUMNS = [n for n, _ in GOLD_FIELDS]
GOLD = T.StructType([T.StructField(n, t) for n, t in GOLD_FIELDS])
