import datetime as dt

from lotwright.operators import quality as Q
from lotwright.schemas import LISTINGS


def _frame(spark, overrides):
    base = {f.name: None for f in LISTINGS.fields}
    recs = []
    for o in overrides:
        r = dict(base)
        r.update(o)
        recs.append(tuple(r[f.name] for f in LISTINGS.fields))
    return spark.createDataFrame(recs, LISTINGS)


def test_boundaries(spark):
    cases = [
        ({"listing_id": 1, "price": 1}, []),
        ({"listing_id": 2, "price": 0}, ["price_range"]),
        ({"listing_id": 3, "price": 20_000_000}, []),
        ({"listing_id": 4, "price": 20_000_001}, ["price_range"]),
        ({"listing_id": 5, "manufactured": 1929}, ["manufactured_range"]),
        ({"listing_id": 6, "transmission": "CVT"}, ["transmission_enum"]),
        ({"listing_id": 7, "reg_date": "03-2008"}, []),
        ({"listing_id": 8, "reg_date": "2008-03-27"}, ["reg_date_format"]),
        ({"listing_id": 9, "coe_remaining": "5y (renewed)"}, []),
        ({"listing_id": 10, "coe_remaining": "five years"}, ["coe_remaining_format"]),
        ({"listing_id": 11, "detail_url": "https://x/used-cars/info/1"}, ["url_prefix"]),
        ({"listing_id": 12, "power": float("nan")}, []),
        ({"listing_id": 0}, ["positive_int"]),
        ({"listing_id": 13, "car_name": ""}, []),
        ({"listing_id": 14, "mileage_km": 5_000_000}, ["mileage_range"]),
    ]
    v = Q.validate(_frame(spark, [c for c, _ in cases]))
    got = {r["listing_id"]: [f["rule_name"] for f in r["_failures"]] for r in v.collect()}
    # listing_id 0 is cleaned to NULL in the record; its failure keeps the raw id
    recs, fails = Q.split_validated(v)
    ids = {r["listing_id"] for r in recs.collect()}
    assert None in ids and 0 not in ids
    by_id = {}
    for f in fails.collect():
        by_id.setdefault(f["listing_id"], []).append(f["rule_name"])
    for c, want in cases:
        assert by_id.get(c["listing_id"], []) == want, c
    assert got  # every record kept


def test_messages(spark):
    v = Q.validate(_frame(spark, [{"listing_id": 5, "price": -100, "transmission": "CVT",
                                   "detail_url": "/x"}]))
    _, f = Q.split_validated(v)
    msgs = sorted(r["reason"] for r in f.collect())
    assert msgs == ["detail_url: '/x' does not start with '/used-cars/info/'",
                    "price: -100 outside range [1, 20000000]",
                    "transmission: 'CVT' not in ['Auto', 'Manual']"]


def test_batch_and_quarantine(spark):
    v = Q.validate(_frame(spark, [{"listing_id": 1, "price": 50000}, {"listing_id": 2, "price": -100},
                                  {"listing_id": 3, "price": 75000}]))
    recs, fails = Q.split_validated(v)
    assert recs.count() == 3 and fails.count() == 1
    q = Q.to_quarantine(fails, 7, dt.datetime(2024, 1, 1))
    r = q.first()
    assert r["scrape_run_id"] == 7 and r["resolved"] is False and r["raw_record"] is None
    assert r["field_value"] == "-100"
    s = Q.quarantine_stats(q).first()
    assert (s["total"], s["unresolved"]) == (1, 1)


def test_split_forms_agree(spark):
    from paths import MID
    from lotwright.sources import testviews as TV
    s = TV.silver(spark, MID)
    r1, f1 = Q.split_validated(Q.validate(s))
    r2, f2 = Q.validate_split(s)
    assert sorted(map(tuple, f1.collect())) == sorted(map(tuple, f2.collect()))
    assert r1.exceptAll(r2).count() == 0 and r2.exceptAll(r1).count() == 0
