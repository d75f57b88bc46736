import datetime as dt

from pyspark.sql import functions as F

from lotwright.functions import scalars as SC


def one(spark, value, fn, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(fn(F.col("v")).alias("x")).first()["x"]


def test_coe_months(spark):
    cases = {"5y 3m": 63, "10y": 120, "3m 15d": 3, "5y (renewed)": 60, None: None, "": None,
             "2y 11m": 35, "0y 0m": None}
    for k, v in cases.items():
        assert one(spark, k, SC.coe_months) == v, k


def test_enum_normalisation(spark):
    fuel = {"Petrol": "Petrol", "Petrol-Electric": "Hybrid", "Diesel": "Diesel",
            "Diesel (Euro 5 Engine and Above)": "Diesel", "Electric": "Electric", None: None, "CNG": None}
    for k, v in fuel.items():
        assert one(spark, k, SC.normalize_fuel) == v, k
    vt = {"SUV": "SUV", "Mid-Sized Sedan": "Sedan", "Hatchback": "Hatchback", "$15c": None,
          None: None, "Van": None}
    for k, v in vt.items():
        assert one(spark, k, SC.normalize_vehicle_type) == v, k
    st = {"Available for sale": "Available", "SOLD": "Sold", "CLOSED": "Closed", None: "Available",
          "N.A.": "Available", "Delisted": "Available", "Reserved": "Reserved"}
    for k, v in st.items():
        assert one(spark, k, SC.normalize_status) == v, k
    assert one(spark, "Delisted", lambda c: SC.normalize_status(c, keep_delisted=True)) == "Delisted"


def test_reg_date(spark):
    cases = {"27-Mar-2008": "2008-03-27", "06-Jan-2016": "2016-01-06", None: None, "": None,
             "not-a-date": None, "03-2008": None, "27-March-2008": None, "31-Feb-2020": None}
    for k, v in cases.items():
        assert one(spark, k, SC.reg_date_iso) == v, k


def test_days_on_market(spark):
    as_of = dt.date(2024, 1, 15)
    cases = {"01-Jan-2024": 14, None: None, "20-Jan-2024": 0, "2024-01-01": 14, "garbage": None}
    for k, v in cases.items():
        assert one(spark, k, lambda c: SC.days_on_market(c, as_of)) == v, k


def test_ratio_and_age(spark):
    df = spark.createDataFrame([(100000, 50000, 2020), (0, 50000, 0), (1000, 16000, None),
                                (5, 0, 2000)], "price long, omv long, manufactured int")
    got = df.select(SC.price_to_omv_ratio(F.col("price"), F.col("omv")).alias("r"),
                    SC.age_years(F.col("manufactured"), dt.date(2024, 6, 1)).alias("a")).collect()
    assert [(r["r"], r["a"]) for r in got] == [(2.0, 4), (None, None), (0.062, None), (None, 24)]
