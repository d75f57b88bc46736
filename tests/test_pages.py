"""Bronze page parsing on hand-written payload fixtures (the driver's pages
carry no payload chunks)."""

import pytest

from lotwright.sources import pages as PG

HOST = "www.example.com"


def push(text):
    return 'self.__next_f.push([1,"' + text + '"])'


LISTING = ("<html><script>" + push(
    r'5:[\"$\",\"div\",null,{\"id\":123,\"link\":\"https://www.example.com/used-cars/info/abc-123/?x=1\"},'
    r'{\"id\":124,\"link\":\"https://www.example.com/used-cars/info/def-124/\"},'
    r'{\"id\":123,\"link\":\"https://www.example.com/used-cars/info/dup-123\"}]') + "</script></html>")

DETAIL = ("<html><head><title>Used 2019 Toyota Corolla for Sale</title></head><script>"
          + push(r'1a:{\"price\":\"$85,000\",\"road_tax\":\"$1,200/yr\",\"features\":\"LED lights '
                 r'View specs of the car\",\"mileage\":\"45,000 km\",\"type_of_vehicle\":\"$15f\",'
                 r'\"carmodel\":\"Toyota Corolla Altis 1.6A\",\"is_direct_owner\":\"1\",'
                 r'\"coe_left\":\"1yr 5mths 28days COE left\",\"power\":\"92 kW\",\"owners\":2,'
                 r'\"depreciation\":\"N.A.\",\"accessories\":\"  \",\"status\":\"Available for sale\"}')
          + "</script><script>" + push(r'15f:{\"text\":\"SUV\",\"link\":\"/x\"}') + "</script></html>")

FALLBACK = ("<html><title>Used 2020 Honda Civic 1.6A for Sale</title><script>"
            + push(r'2b:{\"road_tax\":\"$800\",\"features\":\"Sunroof\",\"type_of_vehicle\":\"$99z\",'
                   r'\"is_direct_owner\":\"0\",\"coe_left\":\"New 10-yr COE\"}') + "</script></html>")

EMPTY = "<html><title>Used 2018 Mazda 3 for Sale</title><p>sold out</p></html>"


@pytest.fixture(scope="module")
def parsed(spark):
    pages = spark.createDataFrame([(1, "u", DETAIL), (2, "u", FALLBACK), (3, "u", EMPTY)],
                                  "page_id long, url string, html string")
    return {r["listing_id"]: r.asDict() for r in PG.parse_detail_pages(pages).collect()}


def test_detail_with_price(parsed):
    r = parsed[1]
    assert r["price"] == 85000 and r["road_tax"] == 1200 and r["mileage_km"] == 45000
    assert r["features"] == "LED lights" and r["accessories"] is None
    assert r["vehicle_type"] == "SUV"                  # $15f resolved in the same page
    assert r["car_name"] == r["car_model"] == "Toyota Corolla Altis 1.6A"
    assert r["listing_type"] == "Direct Owner" and r["coe_remaining"] == "1y 5m"
    assert r["power"] == 92.0 and r["owners"] == 2 and r["depreciation"] is None
    assert r["status"] == "Available for sale"


def test_fallback_line_and_unresolved_ref(parsed):
    r = parsed[2]
    assert r["price"] is None and r["road_tax"] == 800 and r["features"] == "Sunroof"
    assert r["vehicle_type"] == "$99z"                 # unresolved keeps the reference
    assert r["car_name"] == "Honda Civic 1.6A"         # title fallback
    assert r["listing_type"] == "Dealer" and r["coe_remaining"] == "10y (renewed)"


def test_page_without_data_is_empty(parsed):
    r = parsed[3]
    assert all(v is None for k, v in r.items() if k != "listing_id")


def test_listing_links_first_wins(spark):
    pages = spark.createDataFrame([(1, "u", LISTING)], "page_id long, url string, html string")
    got = {r["listing_id"]: r["detail_url"] for r in PG.discover_links(pages, HOST).collect()}
    assert got == {123: "/used-cars/info/abc-123", 124: "/used-cars/info/def-124"}


def test_scalar_parsers(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("$1,234.9 as of today",), ("N.A.",), ("",), ("1.5 (x)",), ("abc",)], "v string")
    got = df.select(PG.parse_money(F.col("v")).alias("m"), PG.parse_int(F.col("v")).alias("i"),
                    PG.parse_float(F.col("v")).alias("f")).collect()
    assert [tuple(r) for r in got] == [(1234, 12349, 1.0), (None, None, None), (None, None, None),
                                       (None, 15, 1.5), (None, None, None)]
