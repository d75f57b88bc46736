"""Car-name parsing: cases transcribed from the behaviour being reproduced."""

import pytest
from pyspark.sql import functions as F

from lotwright.functions import names as N

# (car_name, brand, model, trim); None = must be NULL, ... = not asserted
CASES = [
    ("Toyota Corolla 1.6A", "Toyota", "Corolla", "1.6A"),
    ("Mercedes-Benz C-Class C180 Avantgarde", "Mercedes-Benz", "C-Class C180", "Avantgarde"),
    ("Mercedes-Benz E-Class E200 Avantgarde", "Mercedes-Benz", "E-Class E200", "Avantgarde"),
    ("Mercedes-Benz GLC-Class GLC300 Coupe Mild Hybrid AMG Line", "Mercedes-Benz", "GLC-Class GLC300",
     "Coupe Mild Hybrid AMG Line"),
    ("Mercedes-Benz S-Class S350d", "Mercedes-Benz", "S-Class S350d", None),
    ("Mercedes-Benz EQA Electric EQA250 AMG Line", "Mercedes-Benz", "EQA250", "AMG Line"),
    ("Mercedes-Benz AMG GT 63 S 4MATIC Premium Plus", "Mercedes-Benz", "AMG GT", "63 S 4MATIC Premium Plus"),
    ("Mercedes-Benz Maybach S580", "Mercedes-Benz", "Maybach", "S580"),
    ("BMW 3 Series 330i M-Sport", "BMW", "3 Series 330i", "M-Sport"),
    ("BMW 1 Series 118i 5DR", "BMW", "1 Series 118i", "5DR"),
    ("BMW 3 Series M-Sport", "BMW", "3 Series", "M-Sport"),
    ("BMW M3 Competition", "BMW", "M3", "Competition"),
    ("BMW M5 Competition", "BMW", "M5", "Competition"),
    ("BMW M135i 5DR", "BMW", "M135i", "5DR"),
    ("BMW X5 xDrive40i M-Sport", "BMW", "X5", "xDrive40i M-Sport"),
    ("BMW iX1 Electric eDrive20", "BMW", "iX1", "Electric eDrive20"),
    ("BMW iX Electric xDrive40", "BMW", "iX", "Electric xDrive40"),
    ("BMW XM", "BMW", "XM", None),
    ("BMW i4 eDrive40 M-Sport", "BMW", "i4", "eDrive40 M-Sport"),
    ("Tesla Model 3 Electric RWD", "Tesla", "Model 3", "Electric RWD"),
    ("Tesla Model S Performance", "Tesla", "Model S", "Performance"),
    ("Tesla Cybertruck AWD", "Tesla", "Cybertruck", "AWD"),
    ("Lexus IS250 Luxury", "Lexus", "IS250", "Luxury"),
    ("Lexus RX350 Premium", "Lexus", "RX350", "Premium"),
    ("Lexus ES Hybrid ES300h Executive Sunroof", "Lexus", "ES300h", "Executive Sunroof"),
    ("Lexus RZ Electric RZ450e Luxury", "Lexus", "RZ450e", "Luxury"),
    ("Lexus GS300", "Lexus", "GS300", None),
    ("Volvo XC60 T6 R-Design", "Volvo", "XC60", "T6 R-Design"),
    ("Volvo S60 T5", "Volvo", "S60", "T5"),
    ("Volvo EX40 Twin Motor", "Volvo", "EX40", "Twin Motor"),
    ("BYD Atto 3 Electric Extended Range", "BYD", "Atto 3", "Electric Extended Range"),
    ("BYD Atto 2 Electric Premium", "BYD", "Atto 2", "Electric Premium"),
    ("BYD Sealion 7 Electric Dynamic", "BYD", "Sealion 7", "Electric Dynamic"),
    ("BYD Seal 6 Electric Premium", "BYD", "Seal 6", "Electric Premium"),
    ("BYD Seal Electric Performance", "BYD", "Seal", "Electric Performance"),
    ("Porsche Cayenne Platinum Edition", "Porsche", "Cayenne", "Platinum Edition"),
    ("Porsche 911 Carrera S", "Porsche", "911", "Carrera S"),
    ("Lamborghini Huracan STO", "Lamborghini", "Huracan", "STO"),
    ("Land Rover Range Rover 3.0A", "Land Rover", "Range Rover", "3.0A"),
    ("", "Unknown", None, None),
    (None, "Unknown", None, None),
    ("BMW", "BMW", None, None),
    ("Honda Civic 1.6A (COE till 03/2030)", "Honda", "Civic", "1.6A"),
    ("Mazda 3 2.0A (New 10-yr COE)", "Mazda", "3", "2.0A"),
    ("Zippy Zoomer GT", "Zippy", "Zoomer GT", None),
    ("Audi A4 2.0A Sport", "Audi", "A4", "2.0A Sport"),
    ("Honda Civic Sport", "Honda", "Civic", "Sport"),
    ("smart fortwo cabrio", "Smart", "fortwo cabrio", None),
    ("Kia Cerato K3 A", "Kia", "Cerato K3", "A"),
    ("A Class Thing", "A", "Class Thing", None),
    ("Nissan 1.6A Sylphy", "Nissan", "1.6A Sylphy", None),
    ("Sinotruk HOWO A7", "SINOTRUK", "HOWO A7", None),
    ("Mitsubishi Fuso Canter", "Mitsubishi Fuso", "Canter", None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, car_name string")
    out = N.with_brand_model_trim(df).select("i", "_bmt.brand", "_bmt.model", "_bmt.trim")
    return {r["i"]: (r["brand"], r["model"], r["trim"]) for r in out.collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_brand_model_trim(parsed, i):
    name, brand, model, trim = CASES[i]
    assert parsed[i] == (brand, model, trim), name


def test_brand_only_matches_full_parse(spark, parsed):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, car_name string")
    got = {r["i"]: r["b"] for r in df.select("i", N.brand_only(F.col("car_name")).alias("b")).collect()}
    assert got == {i: v[0] for i, v in parsed.items()}


COMMERCIAL = [
    ("Van", "Toyota", "Toyota Hiace", True),
    ("SUV", "Hino", "Hino 300", True),
    ("SUV", "Toyota", "Toyota ProAce Verso", True),
    ("Sedan", "Nissan", "Nissan nv200 van", True),
    ("Bus/Mini Bus", None, "Anything", True),
    ("SUV", "Toyota", "Toyota Harrier", False),
    (None, None, None, False),
    ("SUV", "SINOTRUK", "Sinotruk HOWO", False),   # commercial set spells it Sinotruk
    ("Truck", "Isuzu", "Isuzu NPR", True),
]


def test_commercial(spark):
    df = spark.createDataFrame([(i, c[0], c[2]) for i, c in enumerate(COMMERCIAL)],
                               "i int, vehicle_type string, car_name string")
    got = {r["i"]: r["x"] for r in df.select(
        "i", N.is_commercial(F.col("vehicle_type"), F.col("car_name")).alias("x")).collect()}
    assert got == {i: c[3] for i, c in enumerate(COMMERCIAL)}


def test_commercial_brand_regex_equals_parsed_brand(spark):
    from paths import MID
    from lotwright.functions import lookups as LK
    from lotwright.sources import testviews as TV
    names = [c[0] for c in CASES] + [
        "Hino 300", "hino 300", "HINO", "Hino-X 1", "Maxus V80", "MAXUS V80", "SOKON Glory", "Sokon x",
        "Sinotruk HOWO", "SINOTRUK HOWO", "Mitsubishi Fuso Canter", "mitsubishi fusoX", "Mitsubishi Lancer",
        "Isuzu D-Max", "UD Quon", "Land Rover Defender", "  Scania R500", "Golden Dragon", "Iveco",
        "Toyota Hiace (renewed)", "(renewed) Hino 300", "MAN TGS", "man tgs", "Mana X"]
    df = spark.createDataFrame([(n,) for n in names], "car_name string")
    df = df.unionByName(TV.silver(spark, MID).select("car_name"))
    got = df.select(
        F.coalesce(N.clean_car_name(F.col("car_name")).rlike(N.commercial_brand_regex()), F.lit(False)).alias("a"),
        F.coalesce(N.brand_only(F.col("car_name")).isin(*LK.COMMERCIAL_BRANDS), F.lit(False)).alias("b"),
        "car_name")
    bad = got.where(F.col("a") != F.col("b")).collect()
    assert bad == []
