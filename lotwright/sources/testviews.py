"""Views over the driver's test tables that play the pipeline's inputs.

* ``silver``: one listing per ``orders`` row (``listing_id = o_orderkey``); the
  other 27 columns are derived by integer arithmetic on the key, so every
  rule, parser branch and NULL pattern is exercised and the view grows with
  ``orders``.
* ``feed``: the change feed from ``events`` (``listing_id = user_id``).

The same derivation is written in DuckDB SQL in ``oracle/views.py``; the two
must stay in step.  The lists below are test-fixture choices, not reference
values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LISTINGS

# Car names chosen so that every parsing branch is hit: multi-word brands,
# brand patterns (anchored and unanchored), engine codes, bare A/M tokens,
# trim keywords, COE suffixes, commercial brands/models, unknown brands,
# lower-case brand spelling, NULL.
CAR_NAMES = [
    "Toyota Corolla Altis 1.6A Elegance (COE till 03/2030)",
    "Mercedes-Benz C-Class C180 Avantgarde",
    "Mercedes-Benz EQA250 AMG Line",
    "BMW 3 Series 330i M Sport",
    "BMW X5 xDrive40i",
    "Honda Vezel 1.5A X (New 10-yr COE)",
    "Tesla Model 3 Long Range",
    "Lexus RX350 Luxury",
    "Volvo XC60 T8 Recharge R-Design",
    "Porsche Cayenne Coupe 3.0A Tip",
    "Toyota Hiace 3.0M Commuter",
    "Hino 300 Series",
    "Land Rover Range Rover Sport 3.0A HSE",
    "Mitsubishi Fuso Canter",
    "Nissan NV200 1.6M",
    "Audi A4 Sedan Sport Edition",
    "Mazda 3 HB Deluxe",
    "smart fortwo cabrio",
    "Kia Cerato K3 A",
    "BYD Atto 3 Extended Range",
    "Lamborghini Urus 4.0A",
    "Hyundai Avante 1.6A S (COE till 09/2028 renewed)",
    None,
    "Ferrari 488 GTB",
    "Sinotruk HOWO A7",
    "Alfa Romeo Giulia 2.0A Veloce (renewed)",
    "BMW M3 Competition",
    "Volkswagen Golf 1.4A TSI Highline",
    "Mercedes-Benz E-Class E200 Exclusive (New 5-yr COE)",
    "Toyota Camry Hybrid 2.5A Standard",
]
VEHICLE_TYPES = ["SUV", "Luxury Sedan", "Sports Car", "MPV", "Mid-Sized Sedan", "Hatchback",
                 "Stationwagon", "Others", "$15f", "Van", "Truck", None, "Bus/Mini Bus"]
FUEL_TYPES = ["Petrol", "Petrol-Electric", "Diesel", "Electric",
              "Diesel (Euro 5 Engine and Above)", "CNG", "Hybrid",
              "Diesel-Electric (Euro 5 Engine and Above)", None,
              "Diesel (Registered as Commercial Vehicle)", "Kerosene"]
TRANSMISSIONS = ["Auto", "Manual", "Auto", "CVT"]
LISTING_TYPES = ["Dealer", "Direct Owner", None]

# Gold rebuilds over the test views use this fixed as-of date.
TEST_AS_OF = dt.date(2002, 6, 30)


def _pick(values: list, k: Column) -> Column:
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (k % len(values) + 1).cast("int"))


def silver_from_orders(orders: DataFrame) -> DataFrame:
    """The 28-column silver listings table (+ ``scraped_at``) from ``orders``."""
    k = F.col("o_orderkey")
    p = F.col("o_totalprice")
    day = F.to_date(F.col("o_orderdate"))
    when = F.when
    posted_day = F.date_add(day, (k % 90).cast("int"))
    st = F.col("o_orderstatus")
    status = (when(k % 53 == 0, "Delisted").when(k % 59 == 0, F.lit(None))
              .when(k % 61 == 0, "N.A.").when(k % 67 == 0, "Sold Out")
              .when(st == "O", "Available for sale").when(st == "F", "SOLD")
              .when(st == "P", "Reserved"))
    # Engine sizes and COE dates vary with the key, so names do too.
    name = F.concat(_pick(CAR_NAMES, k), F.when(k % 5 == 1, F.concat(
        F.lit(" "), (k % 4 + 1).cast("string"), F.lit("."), (k % 10).cast("string"), F.lit("A")))
        .when(k % 5 == 2, F.concat(F.lit(" (COE till 0"), (k % 9 + 1).cast("string"), F.lit("/20"),
                                   (k % 15 + 26).cast("string"), F.lit(")"))).otherwise(F.lit("")))
    cols = {
        "listing_id": k,
        "car_name": name,
        "detail_url": when(k % 17 == 0, F.lit(None))
        .when(k % 19 == 0, F.concat(F.lit("https://example.com/info/"), k.cast("string")))
        .otherwise(F.concat(F.lit("/used-cars/info/"), k.cast("string"))),
        "listing_type": _pick(LISTING_TYPES, k),
        "price": when(k % 11 == 0, F.lit(None)).when(k % 101 == 0, F.lit(-100))
        .otherwise(F.floor(p)),
        "installment": when(k % 4 != 3, F.floor(p / 60)),
        "depreciation": when(k % 9 != 0, (k * 37) % 30000 + 5000),
        "reg_date": when(k % 13 == 0, "N.A.").when(k % 5 == 0, F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, "dd-MMM-yyyy")),
        "coe_remaining": when(k % 7 == 0, F.concat((k % 10).cast("string"), F.lit("y (renewed)")))
        .when(k % 17 == 0, F.concat((k % 12).cast("string"), F.lit("m "),
                                    (k % 28).cast("string"), F.lit("d")))
        .otherwise(F.concat((k % 10).cast("string"), F.lit("y "), (k % 12).cast("string"),
                            F.lit("m"))),
        "mileage_km": when(k % 6 == 0, F.lit(None)).when(k % 997 == 0, F.lit(5000000))
        .otherwise((k * 7919) % 200000),
        "engine_cap_cc": 1000 + (k % 30) * 100,
        "owners": k % 5,
        "fuel_type": _pick(FUEL_TYPES, k),
        "posted_date": when(k % 19 == 0, "yesterday")
        .when(k % 8 == 0, F.date_format(posted_day, "yyyy-MM-dd"))
        .otherwise(F.date_format(posted_day, "dd-MMM-yyyy")),
        "car_model": name,
        "coe": F.floor(p / 4) % 120000,
        "road_tax": 500 + k % 3000,
        "omv": when(k % 8 == 0, F.lit(None)).when(k % 29 == 0, F.lit(0))
        .otherwise((k * 131) % 90000 + 10000),
        "arf": (k * 17) % 100000,
        "power": when(k % 10 != 9, (k % 400) + 0.5),
        "transmission": _pick(TRANSMISSIONS, k),
        "manufactured": when(k % 31 == 0, F.lit(0)).otherwise(1990 + k % 35),
        "dereg_value": (k * 53) % 60000,
        "curb_weight": 1000 + k % 1500,
        "status": status,
        "features": when(k % 3 != 0, F.lit("LED headlights, keyless entry")),
        "accessories": when(k % 4 != 0, F.lit('19" rims, dashcam')),
        "vehicle_type": _pick(VEHICLE_TYPES, k),
        "scraped_at": F.col("o_orderdate").cast("timestamp"),
    }
    return orders.select(*[v.cast(LISTINGS[n].dataType).alias(n) for n, v in cols.items()])


def feed_from_events(events: DataFrame) -> DataFrame:
    """Change feed: one incoming listing record per event.

    ``price`` is NULL for ``view`` events (incoming NULL = keep), the other
    tracked fields are derived from the value and the JSON ``props``."""
    e = F.col("event_type")
    k = F.get_json_object(F.col("props"), "$.k").try_cast("bigint")
    return events.select(
        F.col("user_id").alias("listing_id"),
        F.col("event_id").alias("seq"),
        F.col("ts"),
        F.to_date(F.col("ts")).alias("day"),
        F.when(e != "view", F.floor(F.col("value") * 100)).cast("bigint").alias("price"),
        F.when(k % 3 != 0, k * 100).cast("bigint").alias("depreciation"),
        F.when(e == "signup", F.lit("Reserved")).when(e == "purchase", F.lit("SOLD"))
        .when(e == "error", F.lit(None)).otherwise(F.lit("Available")).alias("status"),
        F.concat(F.lit("/used-cars/info/"), F.col("user_id").cast("string")).alias("detail_url"),
        k.cast("int").alias("owners"),
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table plainly, so filters and columns reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_VIEWS: dict[tuple, DataFrame] = {}


def memo_view(spark: SparkSession, name: str, sf_dir: str, build) -> DataFrame:
    """Build a derived view once per session and input folder.  A DataFrame is
    an immutable plan, so sharing it between queries is safe; it saves the
    Python-side construction of large expression trees on every call."""
    key = (spark.sparkContext.applicationId, name, sf_dir)
    if key not in _VIEWS:
        _VIEWS[key] = build()
    return _VIEWS[key]


def forget_views() -> None:
    """Drop all memoised views (the next query builds, and writes, them anew)."""
    _VIEWS.clear()


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return memo_view(spark, "silver", sf_dir,
                     lambda: silver_from_orders(read_table(spark, sf_dir, "orders")))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return memo_view(spark, "feed", sf_dir,
                     lambda: feed_from_events(read_table(spark, sf_dir, "events")))


# ---------------------------------------------------------------------------
# Text tables for the gate audit and the model-log jobs.  Templates are
# test-fixture choices covering every gate branch; ``{k}`` is replaced by the
# row key, so every row is a distinct text and the table grows with the data.
# ---------------------------------------------------------------------------
SQL_TEMPLATES = [
    "SELECT COUNT(*) FROM listings_gold WHERE brand = 'Toyota'",
    "SELECT brand, AVG(price) FROM listings_gold GROUP BY brand LIMIT {k}",
    "select * from listings_gold limit 50;",
    "SELECT * FROM listings_gold; DROP TABLE listings_gold",
    "DROP TABLE listings_gold",
    "-- just a comment {k}",
    "   ",
    "PRAGMA table_info(listings_gold)",
    "SELECT * FROM sqlite_master",
    "SELECT * FROM users JOIN listings_gold ON 1=1",
    "WITH cheap AS (SELECT * FROM listings_gold WHERE price < {k}) SELECT * FROM cheap",
    "/* top */ SELECT model FROM listings_gold ORDER BY price DESC LIMIT 9999",
    "SELECT * FROM listings_gold LIMIT 0",
    "EXPLAIN SELECT {k}",
    "SELECT {k}",
    "SELECT a.brand FROM listings_gold a JOIN other_table b ON a.listing_id = b.id JOIN third c ON 1=1",
    "ATTACH DATABASE 'x.db' AS x",
    "SELECT * FROM listings_gold WHERE car_name LIKE '%;%'",
    "UPDATE listings_gold SET price = 0",
    "SELECT * FROM (SELECT * FROM listings_gold LIMIT 5) t LIMIT {k}",
]
RESPONSE_TEMPLATES = [
    "Here is the query:\n```sql\nSELECT COUNT(*) FROM listings_gold;\n```\n",
    "SELECT brand FROM listings_gold WHERE price < {k};\n",
    "I cannot answer that.\n",
    "```SQL\nselect * from listings_gold limit 5\n```\nDone.\n",
    "The answer uses select avg(price) from listings_gold;;\n",
]
REVIEW_TEMPLATES = [
    "VERDICT: APPROVED\nREASON: The query is correct.",
    "VERDICT: REJECTED\nREASON: The query would DELETE rows.",
    "verdict: rejected\nreason: Column price_usd does not exist",
    "VERDICT: REJECTED\nREASON: The filter misses the year {k}.",
    "I think it's fine.",
    "VERDICT: APPROVED",
    "VERDICT: REJECTED\nREASON:   ",
]
STEP_NAMES = ["generate", "safety", "review", "execute", "explain"]


def _template(templates: list[str], k: Column) -> Column:
    return F.replace(_pick(templates, k), F.lit("{k}"), k.cast("string"))


def sql_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``queries(query_id, sql_text)``: one logged statement per order."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(k.alias("query_id"), _template(SQL_TEMPLATES, k).alias("sql_text"))


def _assistant_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "conversations").where(F.col("role") == "assistant")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``responses(response_id, text)``: generator output = a template
    followed by the whole assistant turn text."""
    c = _assistant_turns(spark, sf_dir)
    k = F.col("conv_id") * 100 + F.col("turn")
    return c.select(k.alias("response_id"),
                    F.concat(_template(RESPONSE_TEMPLATES, k), F.col("text")).alias("text"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reviews(response_id, text)``: reviewer output = a template followed by
    the whole assistant turn text."""
    c = _assistant_turns(spark, sf_dir)
    k = F.col("conv_id") * 100 + F.col("turn")
    return c.select(k.alias("response_id"),
                    F.concat(_template(REVIEW_TEMPLATES, k), F.lit("\n"), F.col("text")).alias("text"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``attempts``: one generate/gate/review/execute attempt per assistant turn."""
    from pyspark.sql import Window
    c = _assistant_turns(spark, sf_dir)
    cid, t = F.col("conv_id"), F.col("turn")
    it = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    safe = (cid * 3 + t) % 5 != 0
    ok = (cid + 2 * t) % 3 != 0
    return c.select(
        cid.alias("session"), it.cast("int").alias("iteration"),
        F.when((cid + t) % 7 == 0, F.lit("Generation failed: timeout")).alias("generation_error"),
        safe.alias("safety_passed"), ok.alias("approved"),
        F.when((cid + t) % 11 == 0, F.lit("no such column: x")).alias("exec_error"),
        F.when(~safe, F.lit("Dangerous pattern detected")).when(~ok, F.lit("Filter is wrong"))
        .alias("feedback"))


def trace_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trace_steps``: one pipeline step per conversation turn."""
    c = read_table(spark, sf_dir, "conversations")
    cid, t = F.col("conv_id"), F.col("turn")
    name = _pick(STEP_NAMES, t)
    llm = name.isin("generate", "review", "explain")
    prompt = F.when(llm, (cid * 13 + t * 7) % 900 + 100).otherwise(0)
    completion = F.when(llm, (cid * 5 + t * 3) % 200 + 10).otherwise(0)
    return c.select(
        cid.alias("trace_id"), t.cast("int").alias("step"), name.alias("name"),
        (((cid * 37 + t * 11) % 1000) + 0.5).alias("duration_ms"),
        prompt.cast("bigint").alias("prompt_tokens"), completion.cast("bigint").alias("completion_tokens"),
        (prompt + completion).cast("bigint").alias("total_tokens"),
        F.when(llm, F.lit("model-a")).alias("model"),
        F.when((cid + t) % 13 == 0, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        F.when((cid + t) % 13 == 0, F.lit("step failed")).alias("error"),
        # usage metadata as logged by the model client (absent for non-model steps)
        F.when(llm, F.to_json(F.struct(prompt.alias("input_tokens"), completion.alias("output_tokens"),
                                       (prompt + completion).alias("total_tokens"))))
        .alias("usage_metadata"))


# ---------------------------------------------------------------------------
# Pages with payload chunks, one detail page per order and one listing page
# per 25 orders; every parser branch depends on the key.
# ---------------------------------------------------------------------------
def payload_detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages(page_id, url, html)``: the detail page of every order."""
    k = F.col("o_orderkey")
    n = k.cast("string")
    e = r'\"'                                     # a quote inside a payload

    def text(name, value):
        return F.concat(F.lit(f"{e}{name}{e}:{e}"), value, F.lit(f"{e},"))

    def number(name, value):
        return F.concat(F.lit(f"{e}{name}{e}:"), value.cast("string"), F.lit(","))

    priced = F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(
        text("price", F.concat(F.lit("$"), F.format_number(k * 10 + 1, 0))),
        text("depreciation", F.when(k % 8 == 0, F.lit("N.A.")).otherwise(F.concat(n, F.lit("/yr as of today"))))))
    model = F.when(k % 4 == 0, F.lit("")).otherwise(text("carmodel", F.concat(F.lit("Model "), n)))
    vehicle = F.when(k % 3 == 0, F.lit("$15f")).otherwise(F.lit("Sedan"))
    line = F.concat(
        F.lit("1a:{"), priced, text("road_tax", F.concat(F.lit("$"), (k % 900).cast("string"), F.lit("/yr"))),
        text("features", F.concat(F.lit(r'Rims 19\\\" '), n, F.lit("  View specs of the car"))),
        text("mileage", F.concat(F.format_number(k * 3, 0), F.lit(" km (about)"))),
        text("engine_cap", F.when(k % 97 == 0, F.lit("1598 cc / 2000000000")).otherwise(F.concat(n, F.lit(" cc")))),
        text("type_of_vehicle", vehicle), model, number("owners", k % 6),
        F.lit(f"{e}accessories{e}:{{{e}text{e}:{e}Kit "), n, F.lit(f"{e},{e}x{e}:1}},"),
        text("coe_left", F.when(k % 10 == 0, F.lit("New 10-yr COE")).otherwise(
            F.concat((k % 9).cast("string"), F.lit("yrs "), (k % 12).cast("string"), F.lit("mths 3days")))),
        text("power", F.concat((k % 300).cast("string"), F.lit(".5 kW"))),
        text("is_direct_owner", F.when(k % 2 == 0, F.lit("1")).otherwise(F.lit("0"))),
        F.lit(f"{e}status{e}:{e}Available for sale{e}}}"))
    push = lambda body: F.concat(F.lit('<script>self.__next_f.push([1,"'), body, F.lit('"])</script>'))
    ref = F.when(k % 6 == 0, push(F.lit(f"15f:{{{e}text{e}:{e}SUV{e},{e}link{e}:{e}/x{e}}}"))).otherwise(F.lit(""))
    data = F.when(k % 7 == 0, F.lit("<p>sold out</p>")).otherwise(F.concat(push(line), ref))
    url = F.when(k % 19 == 0, F.concat(F.lit("https://example.com/info/"), n)) \
        .otherwise(F.concat(F.lit("https://www.example.com/used-cars/info/"), n))
    html = F.concat(F.lit("<html><title>Used 2019 Title "), n, F.lit(" for Sale</title>"), data, F.lit("</html>"))
    return read_table(spark, sf_dir, "orders").select(k.alias("page_id"), url.alias("url"), html.alias("html"))


def payload_listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages(page_id, url, html)``: listing pages of 25 keys; every key also
    has a card with another link on the page after its own."""
    k = F.col("o_orderkey")
    e = r'\"'
    cards = read_table(spark, sf_dir, "orders").select(
        k, F.explode(F.array(F.lit(0), F.lit(1))).alias("again")).select(
        (F.floor(k / 25) + F.col("again")).alias("page_id"), "again", k,
        F.concat(F.lit(f"{e}id{e}:"), k.cast("string"), F.lit(f",{e}link{e}:{e}https://www.example.com/used-cars/info/"),
                 F.when(F.col("again") == 1, F.lit("again-")).otherwise(F.lit("car-")), k.cast("string"),
                 F.when(k % 3 == 0, F.lit("/?x=1")).otherwise(F.lit("/")), F.lit(e)).alias("card"))
    # At most 50 cards on a page.
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("again", "o_orderkey", "card"))),
                                    lambda c: c["card"]), "},{")
    return cards.groupBy("page_id").agg(
        F.concat(F.lit('<script>self.__next_f.push([1,"5:[{'), body, F.lit('}]"])</script>')).alias("html")).select(
        "page_id", F.lit("u").alias("url"), "html")
