"""Declarative data-quality rules compiled to Column expressions (VAL-1 .. VAL-11).

A rule is data: ``Rule(column, name, kind, args)``.  ``validate`` compiles the
whole rule list into one projection: an array of failure structs (first
failing rule per column wins) and the cleaned columns (bad value -> NULL).
Everything is a narrow map; no shuffle, no Python per row.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LISTING_TYPES


@dataclass(frozen=True)
class Rule:
    column: str
    name: str
    kind: str            # range | enum | regex | prefix | pass
    args: tuple = ()


# The rule registry, in column order, with its bounds, enums,
# patterns and prefix.
TRANSMISSION_VALUES = ["Auto", "Manual"]
FUEL_TYPE_VALUES = [
    "Petrol", "Diesel", "Electric", "Hybrid", "CNG", "Petrol-Electric",
    "Diesel-Electric",
    "Diesel (Euro 5 Engine and Above)",
    "Diesel (Euro 4 Engine and Below)",
    "Diesel-Electric (Euro 5 Engine and Above)",
    "Diesel (Registered as Commercial Vehicle)",
]
LISTING_TYPE_VALUES = ["Direct Owner", "Dealer"]
STATUS_VALUES = ["Available for sale", "SOLD", "CLOSED", "Available", "Sold", "Reserved", "N.A."]

RULES: list[Rule] = [
    Rule("listing_id", "positive_int", "range", (1, 99_999_999)),
    Rule("price", "price_range", "range", (1, 20_000_000)),
    Rule("installment", "installment_range", "range", (0, 500_000)),
    Rule("depreciation", "depreciation_range", "range", (0, 5_000_000)),
    Rule("mileage_km", "mileage_range", "range", (0, 1_000_000)),
    Rule("engine_cap_cc", "engine_cap_range", "range", (1, 20_000)),
    Rule("owners", "owners_range", "range", (0, 99)),
    Rule("coe", "coe_range", "range", (0, 500_000)),
    Rule("road_tax", "road_tax_range", "range", (0, 100_000)),
    Rule("omv", "omv_range", "range", (0, 1_000_000)),
    Rule("arf", "arf_range", "range", (0, 5_000_000)),
    Rule("power", "power_range", "range", (0, 2000)),
    Rule("manufactured", "manufactured_range", "range", (1930, 2030)),
    Rule("dereg_value", "dereg_range", "range", (0, 5_000_000)),
    Rule("curb_weight", "curb_weight_range", "range", (0, 40_000)),
    Rule("transmission", "transmission_enum", "enum", tuple(TRANSMISSION_VALUES)),
    Rule("fuel_type", "fuel_type_enum", "enum", tuple(FUEL_TYPE_VALUES)),
    Rule("listing_type", "listing_type_enum", "enum", tuple(LISTING_TYPE_VALUES)),
    Rule("status", "status_enum", "enum", tuple(STATUS_VALUES)),
    Rule("reg_date", "reg_date_format", "regex",
         (r"^\d{2}-\d{4}$|^\d{1,2}-[A-Za-z]+-\d{4}$",)),
    Rule("coe_remaining", "coe_remaining_format", "regex",
         (r"^\d+y( \d+m)?( \d+d)?$|^\d+y \(renewed\)$|^\d+m( \d+d)?$",)),
    Rule("posted_date", "posted_date_format", "regex",
         (r"^\d{1,2}-[A-Za-z]+-\d{4}$|^\d{4}-\d{2}-\d{2}$",)),
    Rule("detail_url", "url_prefix", "prefix", ("/used-cars/info/",)),
    Rule("car_name", "non_empty_str", "pass"),
    Rule("car_model", "non_empty_str", "pass"),
    Rule("vehicle_type", "non_empty_str", "pass"),
    Rule("features", "text_blob", "pass"),
    Rule("accessories", "text_blob", "pass"),
]


def _py_list_text(values) -> str:
    """The text of a sorted Python list of strings, as in the reason messages."""
    return "[" + ", ".join(f"'{v}'" for v in sorted(values)) + "]"


def sql_str(text: str) -> str:
    """A Spark SQL string literal (backslash escapes are processed by the parser)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def failure_reason_sql(rule: Rule) -> str | None:
    """Spark SQL expression: reason text when the column breaks ``rule``,
    else NULL.  NULL values pass.  Rules compile to SQL text so that a whole
    registry becomes a handful of expressions (one driver round trip each)."""
    n = f"`{rule.column}`"
    col = rule.column
    if rule.kind == "range":
        lo, hi = rule.args
        nan = f" AND NOT isnan({n})" if LISTING_TYPES.get(col) is not None and \
            LISTING_TYPES[col].typeName() == "double" else ""   # NaN compares false both ways
        return (f"CASE WHEN {n} IS NOT NULL AND NOT ({n} BETWEEN {lo} AND {hi}){nan} THEN "
                f"concat({sql_str(col + ': ')}, CAST({n} AS STRING), "
                f"{sql_str(f' outside range [{lo}, {hi}]')}) END")
    if rule.kind == "enum":
        allowed = ", ".join(sql_str(v) for v in rule.args)
        return (f"CASE WHEN {n} IS NOT NULL AND NOT ({n} IN ({allowed})) THEN "
                f"concat({sql_str(col + ": '")}, {n}, "
                f"{sql_str("' not in " + _py_list_text(rule.args))}) END")
    if rule.kind == "regex":
        return (f"CASE WHEN {n} IS NOT NULL AND NOT ({n} RLIKE {sql_str(rule.args[0])}) THEN "
                f"concat({sql_str(col + ": '")}, {n}, {sql_str("' does not match pattern")}) END")
    if rule.kind == "prefix":
        p = rule.args[0]
        return (f"CASE WHEN {n} IS NOT NULL AND NOT startswith({n}, {sql_str(p)}) THEN "
                f"concat({sql_str(col + ": '")}, {n}, "
                f"{sql_str("' does not start with '" + p + "'")}) END")
    return None   # pass-through rules never fail


def failure_reason(rule: Rule, c: Column | None = None) -> Column | None:
    """Column form of ``failure_reason_sql`` (over the rule's own column)."""
    sql = failure_reason_sql(rule)
    return None if sql is None else F.expr(sql)


def _stage_reasons(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, list[str]]:
    """Add ``_reasons`` = struct(r_i reason, n_i rule name) per ruled column;
    per column the first failing rule (registry order) wins."""
    per_col: dict[str, list[tuple[Rule, str]]] = {}
    for r in rules:
        if r.column in df.columns:
            sql = failure_reason_sql(r)
            if sql is not None:
                per_col.setdefault(r.column, []).append((r, sql))
    cols = list(per_col)
    parts = []
    for i, c in enumerate(cols):
        reasons = [x for _, x in per_col[c]]
        names = [f"CASE WHEN ({x}) IS NOT NULL THEN {sql_str(r.name)} END" for r, x in per_col[c]]
        parts.append(f"'r{i}', coalesce({', '.join(reasons)})" if len(reasons) > 1 else f"'r{i}', {reasons[0]}")
        parts.append(f"'n{i}', coalesce({', '.join(names)})" if len(names) > 1 else f"'n{i}', {names[0]}")
    staged = df.select("*", F.expr(f"named_struct({', '.join(parts)})").alias("_reasons"))
    return staged, cols


def validate(df: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """VAL-7: cleaned columns (bad value -> NULL) plus ``_failures``
    ARRAY<STRUCT<listing_id, field_name, field_value, rule_name, reason>>.
    Reasons are computed once into an attribute that both outputs read."""
    staged, cols = _stage_reasons(df, rules)
    key = "`listing_id`" if "listing_id" in df.columns else "CAST(NULL AS BIGINT)"
    items = ", ".join(
        f"CASE WHEN _reasons.r{i} IS NOT NULL THEN named_struct('listing_id', {key}, "
        f"'field_name', {sql_str(c)}, 'field_value', CAST(`{c}` AS STRING), "
        f"'rule_name', _reasons.n{i}, 'reason', _reasons.r{i}) END" for i, c in enumerate(cols))
    idx = {c: i for i, c in enumerate(cols)}
    out = [f"CASE WHEN _reasons.r{idx[c]} IS NULL THEN `{c}` END AS `{c}`" if c in idx else f"`{c}`"
           for c in df.columns]
    return staged.selectExpr(*out, f"filter(array({items}), x -> x IS NOT NULL) AS _failures")


def validate_split(df: DataFrame, rules: list[Rule] = RULES) -> tuple[DataFrame, DataFrame]:
    """VAL-8 in one pass each: (cleaned records, flattened failures).  The
    failures are an unpivot (``stack``) of the staged reasons filtered to the
    failing ones: no per-row array, no explode."""
    staged, cols = _stage_reasons(df, rules)
    idx = {c: i for i, c in enumerate(cols)}
    records = staged.selectExpr(*[f"CASE WHEN _reasons.r{idx[c]} IS NULL THEN `{c}` END AS `{c}`"
                                  if c in idx else f"`{c}`" for c in df.columns])
    key = "`listing_id`" if "listing_id" in df.columns else "CAST(NULL AS BIGINT)"
    args = ", ".join(f"{sql_str(c)}, CAST(`{c}` AS STRING), _reasons.n{i}, _reasons.r{i}"
                     for i, c in enumerate(cols))
    failures = staged.selectExpr(
        f"{key} AS listing_id",
        f"stack({len(cols)}, {args}) AS (field_name, field_value, rule_name, reason)"
    ).where("reason IS NOT NULL")
    return records, failures


def split_validated(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """VAL-8 from a validated frame: (cleaned records, flattened failures).
    Every record is kept."""
    records = validated.drop("_failures")
    failures = validated.select(F.explode("_failures").alias("f")).select("f.*")
    return records, failures


#: Rule name of a record that came without a key.
MISSING_KEY = "missing_key"


def keyless(validated: DataFrame) -> DataFrame:
    """Failures for the records of a validated frame that came without a key: they can
    only be quarantined, so the row keeps the whole record as JSON."""
    fields = [c for c in validated.columns if c in LISTING_TYPES]
    own = validated.where(F.col("listing_id").isNull()
                          & ~F.exists("_failures", lambda f: f["field_name"] == "listing_id"))
    return own.select(F.lit(None).cast("bigint").alias("listing_id"), F.lit("listing_id").alias("field_name"),
                      F.lit(None).cast("string").alias("field_value"), F.lit(MISSING_KEY).alias("rule_name"),
                      F.lit("listing_id: missing").alias("reason"),
                      F.to_json(F.struct(*fields)).alias("raw_record"))


def is_valid() -> Column:
    """VAL-11: no failure for the record, over the result of ``validate``."""
    return F.size("_failures") == 0


def to_quarantine(failures: DataFrame, run_id: int | None, quarantined_at: dt.datetime) -> DataFrame:
    """VAL-10 / SNK-3 input: failures as quarantine rows (``raw_record`` NULL
    unless given, unresolved).  ``run_id`` is always recorded."""
    raw = F.col("raw_record") if "raw_record" in failures.columns else F.lit(None)
    return failures.select(
        "listing_id", "field_name", "field_value", "rule_name", "reason",
        raw.cast("string").alias("raw_record"),
        F.lit(quarantined_at).cast("timestamp").alias("quarantined_at"),
        F.lit(run_id).cast("bigint").alias("scrape_run_id"),
        F.lit(False).alias("resolved"))


def quarantine_stats(quarantine: DataFrame) -> DataFrame:
    """AGG-5 totals: one row (total, unresolved)."""
    return quarantine.agg(F.count(F.lit(1)).alias("total"),
                          F.count_if(~F.coalesce(F.col("resolved"), F.lit(False))).alias("unresolved"))


def quarantine_by_rule(quarantine: DataFrame) -> DataFrame:
    """AGG-5 / TOP-4: failures per rule, most frequent first."""
    return (quarantine.groupBy("rule_name").agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), "rule_name"))


def quarantine_recent(quarantine: DataFrame, limit: int = 50) -> DataFrame:
    """TOP-1: newest quarantine rows; key tiebreak keeps the top-k deterministic."""
    return (quarantine.orderBy(F.desc("quarantined_at"), F.desc("listing_id"), "field_name")
            .limit(limit))

