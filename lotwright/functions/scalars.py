"""Scalar Column functions of the gold transform (FN-7 .. FN-15).

All take and return Columns; no Python runs per row.  ``as_of`` is always an
explicit date parameter so that a rebuild is reproducible.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lookups as LK
from .names import strip_ws


def _map(d: dict) -> Column:
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def digits_to_long(digits: Column) -> Column:
    """A run of digits (``''`` when a regex found none) as BIGINT.  The empty
    case is answered before the cast: a failing cast raises and catches an
    exception inside ``try_cast``, which costs more than the regex itself."""
    return F.when(digits != "", digits.try_cast("bigint"))


def coe_total_months(coe_remaining: Column) -> Column:
    """Years * 12 + months of a COE text (0 when neither is present, NULL beyond BIGINT)."""
    text = strip_ws(coe_remaining)
    years = digits_to_long(F.regexp_extract(text, r"(\d+)y", 1))
    months = digits_to_long(F.regexp_extract(text, r"(\d+)m", 1))
    return F.try_add(F.try_multiply(F.coalesce(years, F.lit(0)), F.lit(12)), F.coalesce(months, F.lit(0)))


def coe_months(coe_remaining: Column, total: Column | None = None) -> Column:
    """FN-7: ``5y 3m`` -> 63, ``10y`` -> 120, ``3m 15d`` -> 3; 0, missing or beyond INT -> NULL.
    ``total`` is ``coe_total_months(coe_remaining)`` when already computed."""
    total = coe_total_months(coe_remaining) if total is None else total
    return F.when((coe_remaining != "") & (total > 0), total.try_cast("int"))


def normalize_fuel(fuel: Column) -> Column:
    """FN-8: raw fuel text -> Petrol/Hybrid/Diesel/Diesel-Hybrid/Electric, else NULL."""
    return F.try_element_at(_map(LK.FUEL_TYPE_MAP), fuel)


def normalize_vehicle_type(vt: Column) -> Column:
    """FN-9: raw vehicle type -> gold enum; unresolved ``$15x`` codes -> NULL."""
    return F.when(~vt.isin(*LK.COE_CATEGORY_CODES),
                  F.try_element_at(_map(LK.VEHICLE_TYPE_MAP), vt))


def normalize_status(status: Column, keep_delisted: bool = False) -> Column:
    """FN-10: raw status -> gold enum; NULL or unknown (incl. Delisted) -> Available.

    ``keep_delisted=True`` keeps ``Delisted`` (the documented intent)."""
    m = dict(LK.STATUS_MAP)
    if keep_delisted:
        m["Delisted"] = "Delisted"
    return F.coalesce(F.try_element_at(_map(m), status), F.lit(LK.DEFAULT_STATUS))


def parse_day_mon_year(text: Column) -> Column:
    """``27-Mar-2008`` (1-2 digit day, 3-letter month, 4-digit year) -> DATE."""
    t = strip_ws(text)
    return F.when(t.rlike(r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"), F.try_to_date(t, "d-MMM-yyyy"))


def parse_iso_day(text: Column) -> Column:
    t = strip_ws(text)
    return F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(t, "yyyy-M-d"))


def reg_date_iso(reg_date: Column) -> Column:
    """FN-11: ``d-Mon-YYYY`` -> ``YYYY-MM-DD`` text; anything else -> NULL."""
    return F.date_format(parse_day_mon_year(reg_date), "yyyy-MM-dd")


def posted_day(posted: Column) -> Column:
    """The posted date: ``d-Mon-YYYY`` first, then ``YYYY-M-D``."""
    return F.coalesce(parse_day_mon_year(posted), parse_iso_day(posted))


def days_on_market(posted: Column, as_of: dt.date, day: Column | None = None) -> Column:
    """FN-12: days from the posted date (two formats tried) to ``as_of``, >= 0.
    ``day`` is ``posted_day(posted)`` when already computed."""
    d = posted_day(posted) if day is None else day
    delta = F.datediff(F.lit(as_of), d)
    return F.when(d.isNotNull(), F.greatest(delta, F.lit(0))).cast("int")


def price_to_omv_ratio(price: Column, omv: Column) -> Column:
    """FN-13: price/omv rounded half-even to 3 places when price != 0 and omv > 0."""
    return F.when((price != 0) & (omv > 0), F.bround(price / omv, 3))


def age_years(manufactured: Column, as_of: dt.date) -> Column:
    """FN-14: ``as_of`` year minus the manufacture year; 0 or NULL year -> NULL."""
    return F.when(manufactured != 0, F.lit(as_of.year) - manufactured).cast("int")


def values_equal(current: Column, incoming: Column, is_float: bool = False) -> Column:
    """FN-15: change-detection equality.  Incoming NULL means "keep", so equal;
    existing NULL with a new value is a change; floats compare within 0.01."""
    if is_float:
        same = F.abs(current.cast("double") - incoming.cast("double")) < LK.FLOAT_EPSILON
    else:
        same = current == incoming
    return incoming.isNull() | (current.isNotNull() & F.coalesce(same, F.lit(False)))
