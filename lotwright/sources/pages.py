"""Bronze pages -> silver records (SCR-1 .. SCR-14) as per-page projections.

A page is one row ``(page_id, url, html)``.  Every step below is a narrow
expression over that row: payload extraction, choice of the data line, the
25 field extractions, ``$ref`` resolution (searched inside the same page's
payload) and type parsing.  No explode, no shuffle: parsing scales with the
number of pages and never moves a page between tasks.

Payload encoding: the page embeds Next.js push chunks
``self.__next_f.push([1,"..."])`` whose text holds JSON with backslash-escaped
quotes, so a key appears as ``\\"price\\":`` in the raw text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import blank_to_null, strip_ws
from ..schemas import LISTING_COLUMNS, LISTING_TYPES

# Payload chunk pattern, detail field list, markers.
RSC_CHUNK_REGEX = r'(?s)self\.__next_f\.push\(\[1,"(.*?)"\]\)'
DETAIL_FIELDS = [
    "price", "installment", "depreciation", "reg_date",
    "coe_left", "mileage", "engine_cap", "road_tax",
    "dereg_value", "coe", "omv", "arf", "power",
    "curb_weight", "owners", "manufactured",
    "transmission", "fuel_type", "features",
    "accessories", "status", "posted_on", "is_direct_owner",
]
DATA_LINE_MARKERS = ("road_tax", "features")
TITLE_MODEL_REGEX = r"<title>Used \d+ (.*?) for Sale"
FEATURES_CUT = "View specs of the"
INFO_PATH = "/used-cars/info/"

BS = "\\\\"        # regex for one literal backslash
Q = BS + '"'       # regex for the escaped quote \"


def rsc_payload(html: Column) -> Column:
    """SCR-1: all push-chunk texts joined by newlines (raw, still escaped)."""
    return F.array_join(F.regexp_extract_all(html, F.lit(RSC_CHUNK_REGEX), 1), "\n")


def listing_links(rsc: Column, host: str) -> Column:
    """SCR-2 (per page): ARRAY<STRUCT<pos, listing_id, detail_url>> of listing
    cards in page order; ``host`` is the site the links point to.  The URL
    stops at a quote, backslash or ``?``; CR/LF and trailing ``/`` removed."""
    h = host.replace(".", r"\.")
    rx = (Q + r'id' + Q + r':(\d+),' + Q + r'link' + Q + r':' + Q + r'https://' + h
          + r'(' + INFO_PATH + r'[^\\"?]+)')
    ids = F.regexp_extract_all(rsc, F.lit(rx), 1)
    urls = F.regexp_extract_all(rsc, F.lit(rx), 2)
    clean = F.transform(urls, lambda u: F.regexp_replace(F.regexp_replace(u, "[\r\n]", ""), "/+$", ""))
    return F.transform(F.arrays_zip(ids.alias("id"), clean.alias("url")),
                       lambda x, i: F.struct(i.alias("pos"),
                                             x["id"].cast("bigint").alias("listing_id"),
                                             x["url"].alias("detail_url")))


def data_line(rsc: Column) -> Column:
    """SCR-3: body of the first ``hex:...`` line holding both markers and
    ``price``, else of the first such line at all; NULL when none."""
    lines = F.split(rsc, "\n")
    cand = F.filter(lines, lambda l: l.contains(DATA_LINE_MARKERS[0]) & l.contains(DATA_LINE_MARKERS[1])
                    & strip_ws(l).rlike(r"^[0-9a-f]+:"))
    bodies = F.transform(cand, lambda l: F.regexp_extract(strip_ws(l), r"(?s)^[0-9a-f]+:(.*)", 1))
    priced = F.filter(bodies, lambda b: b.contains("price"))
    return F.coalesce(F.try_element_at(priced, F.lit(1)), F.try_element_at(bodies, F.lit(1)))


def _unescape(v: Column) -> Column:
    v = F.replace(v, F.lit("\\\\\\\""), F.lit('"'))      # \\\" -> "
    v = F.replace(v, F.lit("\\\\"), F.lit("\\"))          # \\   -> \
    return F.replace(v, F.lit("\\n"), F.lit("\n"))        # \n   -> newline


def field_regex(name: str) -> str:
    """The four patterns of a field as one ordered alternation.

    Alternative i is ``.*?P_i.*`` under DOTALL: it matches iff P_i matches
    somewhere and its lazy prefix finds P_i's first match, so "first pattern
    that matches anywhere" is kept.  Inside the values ``.`` must not cross a
    line break (as in the per-pattern form), hence ``[^\n]*?``."""
    k = Q + name + Q + ":"
    v = r"([^\n]*?)"
    p1 = k + Q + v + Q + "," + Q
    p2 = k + Q + v + Q + r"\}"
    p3 = k + r"(\d+)"
    p4 = k + r"\{" + Q + "text" + Q + ":" + Q + v + Q
    return r"(?s)^(?:.*?" + p1 + r".*|.*?" + p2 + r".*|.*?" + p3 + r".*|.*?" + p4 + r".*)$"


def field(payload: Column, name: str) -> Column:
    """SCR-4: one field by four patterns in priority order (string before
    the next key, string closing the object, digits, nested ``{text}``);
    string values are unescaped (digits have nothing to unescape).  NULL
    when absent."""
    rx = field_regex(name)
    return F.when(payload.rlike(rx), _unescape(F.regexp_replace(payload, rx, "$1$2$3$4")))


def field_entries_regex(names: list[str]) -> str:
    """Zero-width match at every ``\\"name\\":`` of the names; group 1 is the name and the value by the
    first of the four patterns that matches there, delimiters included.

    The kind of an entry shows at its ends.  Pattern i matches somewhere for a
    name, and no earlier one does, exactly if the smallest kind among the
    name's entries is i; the first such entry is then its first match."""
    v = r"[^\n]*?"
    text = Q + v + Q
    value = "|".join([text + "," + Q, text + r"\}", r"\d+", r"\{" + Q + "text" + Q + ":" + text])
    return "(?=" + Q + "((?:" + "|".join(names) + ")" + Q + ":(?:" + value + ")))"


def field_entries(payload: Column, names: list[str]) -> Column:
    """SCR-4/SCR-5: the entries of all names, in one scan of the payload."""
    return F.regexp_extract_all(payload, F.lit(field_entries_regex(names)), 1)


def fields(found: Column) -> tuple[Column, Column]:
    """(names, values) of ``field_entries``, the values bare, best pattern first.  ``found`` is used
    several times: stage it as an attribute."""
    sep = '\\":'                                                   # ends a name
    key = lambda e: F.substring_index(e, sep, 1)                     # noqa: E731
    val = lambda e: F.substr(e, F.length(key(e)) + F.lit(len(sep) + 1))
    kinds = [lambda e: e.endswith('\\",\\"'), lambda e: e.endswith('\\"}'),
             lambda e: e.rlike(r"[0-9]$"), lambda e: val(e).startswith("{")]
    cut = [(2, 5), (2, 3), (0, 0), (len('{\\"text\\":\\"'), 2)]      # delimiters before and after the value
    def bare(before: int, after: int):
        return lambda e: F.substr(val(e), F.lit(before + 1), F.length(val(e)) - F.lit(before + after))

    def without(kind):
        return lambda e: ~kind(e)

    names_of, values_of, rest = [], [], found
    for i, (kind, ends) in enumerate(zip(kinds, cut)):
        mine = F.filter(rest, kind) if i + 1 < len(kinds) else rest
        rest = F.filter(rest, without(kind))
        names_of.append(F.transform(mine, key))
        values_of.append(F.transform(mine, bare(*ends)))
    return F.concat(*names_of), F.concat(*values_of)


def field_of(names: Column, values: Column, name: str) -> Column:
    """One field of ``fields``: its first entry, unescaped; NULL when absent."""
    at = F.array_position(names, F.lit(name))
    return F.when(at > 0, _unescape(F.element_at(values, at.cast("int"))))


def parse_money(raw: Column) -> Column:
    """SCR-8: drop ``$ , /yr``, cut at `` as of``; N.A./empty -> NULL;
    float text truncated to an integer."""
    v = F.replace(F.replace(F.replace(raw, F.lit("$"), F.lit("")), F.lit(","), F.lit("")),
                  F.lit("/yr"), F.lit(""))
    v = strip_ws(F.split_part(v, F.lit(" as of"), F.lit(1)))
    # Only number-like text reaches the cast (a failing cast is an exception).
    d = F.when(v.rlike(r"^[-+]?[0-9._eE+-]*[0-9][0-9._eE+-]*$|^(?i:[-+]?(inf|infinity|nan))$"),
               v.try_cast("double"))
    ok = ~v.isin("N.A.", "N.A", "") & d.isNotNull() & ~F.isnan(d) & (F.abs(d) != float("inf"))
    return F.when((raw != "") & ok, d.try_cast("bigint"))


def parse_int(raw: Column) -> Column:
    """SCR-9: digits of the text before ``(`` (so ``1.5`` -> 15, ``-3`` -> 3)."""
    digits = F.regexp_replace(F.split_part(raw, F.lit("("), F.lit(1)), r"[^0-9]", "")
    return F.when(digits != "", digits.try_cast("bigint"))


def parse_float(raw: Column) -> Column:
    """SCR-10: the first run of digits and dots as a double."""
    first = F.regexp_extract(raw, r"([0-9.]+)", 1)
    return F.when(first.rlike(r"[0-9]"), first.try_cast("double"))


def parse_coe_remaining(raw: Column) -> Column:
    """SCR-11: ``1yr 5mths 28days`` -> ``1y 5m``, ``8yrs`` -> ``8y``,
    ``New 5-yr``/``New 10-yr`` -> ``5y (renewed)``/``10y (renewed)``."""
    ym = r"(\d+)y(?:rs?)?\s*(\d+)m(?:ths?)?"
    y = r"(\d+)y(?:rs?)?"
    return (F.when(raw.rlike(ym), F.concat(F.regexp_extract(raw, ym, 1), F.lit("y "),
                                           F.regexp_extract(raw, ym, 2), F.lit("m")))
            .when(raw.rlike(y), F.concat(F.regexp_extract(raw, y, 1), F.lit("y")))
            .when(raw.contains("New 5-yr"), F.lit("5y (renewed)"))
            .when(raw.contains("New 10-yr"), F.lit("10y (renewed)")))


def resolve_ref(value: Column, rsc: Column) -> Column:
    """SCR-6: a ``$15f`` value points at chunk ``15f:{...}`` of the same page;
    its ``text`` field replaces the value.  The search is unanchored (the
    first ``15f:{`` anywhere, as the reference does); unresolved keeps ``$15f``."""
    ref = F.substring(value, 2, 1 << 30)
    pos = F.instr(rsc, F.concat(ref, F.lit(":{")))
    tail = F.substring(rsc, pos + F.length(ref) + 1, 1 << 30)
    text = field(tail, "text")
    resolved = F.when(value.startswith("$") & (pos > 0) & (text != ""), text)
    return F.coalesce(resolved, value)


def parse_detail_pages(pages: DataFrame) -> DataFrame:
    """SCR-3..13: one silver record per page (``listing_id`` = ``page_id``; see
    ``detail_records`` for keys from the work list).
    Pages without a data line give a record of NULLs."""
    c = F.col
    d = pages.withColumn("_rsc", rsc_payload(c("html")))
    d = d.withColumn("_line", data_line(c("_rsc")))
    wanted = DETAIL_FIELDS + ["type_of_vehicle", "carmodel"]
    d = d.withColumn("_found", field_entries(c("_line"), wanted))
    names, values = fields(c("_found"))
    d = d.select("page_id", "html", "_rsc", "_line", names.alias("_names"), values.alias("_values"))
    raw = {f: field_of(c("_names"), c("_values"), f) for f in wanted}
    d = d.select("page_id", "html", "_rsc", "_line", *[v.alias(f"_raw_{k}") for k, v in raw.items()])
    r = {k: c(f"_raw_{k}") for k in raw}
    title = strip_ws(F.regexp_extract(c("html"), TITLE_MODEL_REGEX, 1))
    title = F.when(c("html").rlike(TITLE_MODEL_REGEX), title)
    # No data line -> empty record: the title fallback only applies to pages with data.
    model = F.when(c("_line").isNotNull(), F.coalesce(blank_to_null(r["carmodel"]), title))
    tov = F.when(r["type_of_vehicle"] != "", resolve_ref(r["type_of_vehicle"], c("_rsc")))
    feats = blank_to_null(strip_ws(F.split_part(r["features"], F.lit(FEATURES_CUT), F.lit(1))))
    out = {
        "listing_id": c("page_id"),
        "car_name": model, "car_model": model,
        "price": parse_money(r["price"]), "installment": parse_money(r["installment"]),
        "depreciation": parse_money(r["depreciation"]), "reg_date": r["reg_date"],
        "coe_remaining": parse_coe_remaining(r["coe_left"]), "posted_date": r["posted_on"],
        "listing_type": F.when(r["is_direct_owner"].isNotNull(),
                               F.when(r["is_direct_owner"] == "1", F.lit("Direct Owner"))
                               .otherwise(F.lit("Dealer"))),
        "road_tax": parse_money(r["road_tax"]), "omv": parse_money(r["omv"]),
        "arf": parse_money(r["arf"]), "coe": parse_money(r["coe"]),
        "dereg_value": parse_money(r["dereg_value"]), "power": parse_float(r["power"]),
        "curb_weight": parse_int(r["curb_weight"]), "mileage_km": parse_int(r["mileage"]),
        "engine_cap_cc": parse_int(r["engine_cap"]), "owners": parse_int(r["owners"]),
        "manufactured": parse_int(r["manufactured"]),
        "transmission": blank_to_null(r["transmission"]), "fuel_type": blank_to_null(r["fuel_type"]),
        "vehicle_type": blank_to_null(tov), "status": blank_to_null(r["status"]),
        "features": feats, "accessories": blank_to_null(strip_ws(r["accessories"])),
        "detail_url": F.lit(None).cast("string"),
    }
    # Integers stay BIGINT, so that a value too large for its column meets the
    # validation rules instead of failing the job.
    wide = {n: "bigint" if t == T.IntegerType() else t for n, t in LISTING_TYPES.items()}
    return d.select(*[(out[n] if n == "listing_id" else out[n].cast(wide[n])).alias(n) for n in LISTING_COLUMNS])


def detail_records(pages: DataFrame, worklist: DataFrame, host: str = "https://www.example.com") -> DataFrame:
    """Detail records of the work list (listing_id, detail_url): a page belongs
    to the entry whose absolute URL it was fetched from, which gives the
    record its key and detail_url.  Pages of no entry give no record."""
    from ..operators.lifecycle import absolute_url
    wanted = worklist.where(F.col("detail_url").isNotNull()).select(
        F.col("listing_id").alias("_key"), F.col("detail_url").alias("_path"),
        absolute_url(F.col("detail_url"), host).alias("url"))
    hits = pages.join(wanted, "url")
    parsed = parse_detail_pages(hits.select(F.struct("_key", "_path").alias("page_id"), "html"))
    out = {"listing_id": F.col("listing_id._key"), "detail_url": F.col("listing_id._path")}
    return parsed.select(*[out.get(n, F.col(n)).alias(n) for n in LISTING_COLUMNS])


def discover_links(pages: DataFrame, host: str) -> DataFrame:
    """SCR-2 + WIN-4: (listing_id, detail_url) of every listing card, the
    first occurrence (page order, then position) winning per id.  The only
    shuffle is the per-id ``min_by`` (partial aggregation combines hot ids)."""
    links = pages.select("page_id", F.explode(listing_links(rsc_payload(F.col("html")), host)).alias("l"))
    first = links.groupBy(F.col("l.listing_id").alias("listing_id")).agg(
        F.min_by(F.col("l.detail_url"), F.struct(F.col("page_id"), F.col("l.pos"))).alias("detail_url"))
    return first


# ---------------------------------------------------------------------------
# Generic HTML shapes used on the driver's pages (no payload chunks there).
# ---------------------------------------------------------------------------
TITLE_REGEX = r"<title>(.*?)</title>"
HREF_REGEX = r'<a href="([^"]*)"'
SCRIPT_REGEX = r"(?s)<script[^>]*>(.*?)</script>"


def page_titles(pages: DataFrame) -> DataFrame:
    t = F.col("html")
    return pages.select("page_id", F.when(t.rlike(TITLE_REGEX), F.regexp_extract(t, TITLE_REGEX, 1))
                        .alias("title"))


def first_links(pages: DataFrame) -> DataFrame:
    """First page (then position) on which every link target appears."""
    links = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(HREF_REGEX), 1))
                         .alias("pos", "href"))
    return links.groupBy("href").agg(
        F.min_by(F.struct("page_id", "pos"), F.struct("page_id", "pos")).alias("first"),
        F.count(F.lit(1)).alias("occurrences")).select(
        "href", F.col("first.page_id").alias("page_id"), F.col("first.pos").alias("pos"),
        "occurrences")


def page_scripts(pages: DataFrame) -> DataFrame:
    s = F.regexp_extract_all("html", F.lit(SCRIPT_REGEX), 1)
    return pages.select("page_id", F.size(s).alias("n_scripts"),
                        F.try_element_at(s, F.lit(1)).alias("first_script"),
                        F.size(F.regexp_extract_all("html", F.lit(RSC_CHUNK_REGEX), 1)).alias("n_chunks"))
