"""Lookup tables that gold and validation results depend on.

Every list and map in this module is a FIXED VALUE: it must equal the
behaviour being reproduced, so it is written out plainly in its natural order.
Code elsewhere compiles these tables into native Column expressions.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Brand dictionary.
# Multi-word brands are tried first, in this order, as case-insensitive
# prefixes.  Single-word brands are compared case-insensitively with the
# first word; their spelling here is the canonical output.
# ---------------------------------------------------------------------------
MULTI_WORD_BRANDS = [
    "Mitsubishi Fuso",
    "Aston Martin",
    "Alfa Romeo",
    "Land Rover",
    "Mercedes-Benz",
    "Rolls-Royce",
]

SINGLE_WORD_BRANDS = [
    "Audi", "AVATR", "Aion", "Austin", "BYD", "BMW", "Bentley",
    "CUPRA", "Cadillac", "CAMC", "Caterham", "Chevrolet", "Chrysler",
    "Citroen", "Dacia", "Daihatsu", "Datsun", "DENZA", "DFSK",
    "DS", "Daimler", "Dodge", "Dongfeng", "Farizon", "Ferrari",
    "Fiat", "Ford", "Forland", "Foton", "Golden", "Higer", "Hino",
    "Honda", "Hummer", "Hyundai", "Infiniti", "Isuzu", "Iveco",
    "JAC", "Jaecoo", "Jaguar", "Jeep", "JMEV", "Kia", "King",
    "KYC", "Lamborghini", "Lexus", "Leyland", "Lotus", "MAN",
    "MG", "MINI", "Maserati", "Maybach", "Mazda",
    "McLaren", "Mitsuoka", "Mitsubishi", "Morgan", "Morris",
    "Nissan", "OHM", "ORA", "Omoda", "Opel", "Peugeot", "Perodua",
    "Polestar", "Pontiac", "Porsche", "Proton", "QingLing", "RUF",
    "Renault", "Riley", "Rover", "SANY", "SEAT", "SRM", "Saab",
    "Scania", "Scion", "Seres", "SINOTRUK", "Skoda", "Smart",
    "Ssangyong", "Subaru", "Suzuki", "TD", "Tesla", "Triumph",
    "UD", "Valiant", "Volkswagen", "Volvo", "XPENG", "Yutong",
    "ZEEKR",
]
# "smart" in lower case is the same brand; the canonical form is "Smart".

# ---------------------------------------------------------------------------
# Brand-specific model patterns, tried in order per brand,
# all case-insensitive.  Group 1 is the model, the text after the match is
# the trim.  Patterns without "^" may match anywhere (text before is dropped).
# ---------------------------------------------------------------------------
BRAND_MODEL_PATTERNS: dict[str, list[str]] = {
    "Mercedes-Benz": [
        r"^((?:[A-Z]{1,3}-Class)\s+[A-Z]{1,3}\d+\w*)",
        r"(EQ[A-ESV]\d+\+?)",
        r"^(AMG GT)\b",
        r"^(Maybach)\b",
        r"^([A-Z]{1,3}-Class)\b",
        r"^(EQ[A-ESV])\b",
    ],
    "BMW": [
        r"^(\d+ Series \d{3}[a-z]*)\b",
        r"^(M\d{3}[a-z]*)\b",
        r"^(M\d{1,2})\b",
        r"^(iX\d+)\b",
        r"^(iX)\b",
        r"^(XM)\b",
        r"^(i\d+)\b",
        r"^(X\d+)\b",
        r"^(Z\d+)\b",
        r"^(\d+ Series)\b",
    ],
    "Tesla": [
        r"^(Model [S3XY])\b",
        r"^(Cybertruck)\b",
    ],
    "Lexus": [
        r"((?:IS|ES|GS|LS|RX|NX|UX|LX|RC|LC|RZ)\d+\w?)",
    ],
    "Volvo": [
        r"^([SVC]X\d+)\b",
        r"^(XC\d+)\b",
        r"^([SVC]\d+)\b",
        r"^(EX\d+|EC\d+|EM\d+)\b",
    ],
    "BYD": [
        r"^(Atto \d+|Denza D9|Sealion \d+|Seal \d+|Seal|Dolphin|eT\d+|T\d+|M6|e6|C\d+|Tang|Han|Song|Yuan|Seagull)\b",
    ],
    "Porsche": [
        r"^(911|Cayenne|Panamera|Macan|Taycan|Boxster|Cayman|718)\b",
    ],
    "Lamborghini": [
        r"^(Huracan|Aventador|Urus|Gallardo|Revuelto|Temerario)\b",
    ],
}

# Trim keywords (case-insensitive, whole words).
TRIM_KEYWORDS = [
    "AMG", "M-Sport", "MSport", "R-Design", "Luxury", "Premium", "Sport", "Exclusive",
    "Progressive", "Avantgarde", "Classic", "Elegance", "Style", "Urban", "Highline",
    "Edition", "Limited", "Signature", "Competition",
]

# Engine-code token and the bare transmission tokens.
ENGINE_CODE_TOKEN = r"^\d+\.\d+[AM]$"
TRANSMISSION_TOKENS = ["A", "M"]

# COE suffixes removed from car names before parsing.
COE_SUFFIX_PATTERN = r"\s*\((COE till \d{2}/\d{4}|New \d+-yr COE|COE till \d{2}/\d{4} renewed)\)"
RENEWED_SUFFIX_PATTERN = r"\s*\(renewed\)"

# ---------------------------------------------------------------------------
# Commercial-vehicle exclusion.
# ---------------------------------------------------------------------------
COMMERCIAL_VEHICLE_TYPES = ["Van", "Truck", "Bus/Mini Bus"]

COMMERCIAL_BRANDS = [
    "Hino", "Scania", "Golden", "Yutong", "SOKON", "Farizon",
    "Forland", "KYC", "Higer", "CAMC", "Sinotruk", "SANY", "JMEV",
    "QingLing", "MAN", "Iveco", "Leyland", "Mitsubishi Fuso",
    "Maxus", "Isuzu", "UD", "SRM",
]

COMMERCIAL_MODEL_WORDS = [
    "ProAce", "NV200", "eDeliver", "e-Dispatch", "e-Berlingo", "Vanette",
    "Combinot", "Canter", "Actros", "Hiace", "Commuter",
]

# ---------------------------------------------------------------------------
# Enum normalisation (silver value -> gold value).
# ---------------------------------------------------------------------------
COE_CATEGORY_CODES = ["$15a", "$15c", "$15d", "$15e", "$15f", "$14e"]

FUEL_TYPE_MAP = {
    "Petrol": "Petrol",
    "Petrol-Electric": "Hybrid",
    "Diesel": "Diesel",
    "Diesel (Euro 5 Engine and Above)": "Diesel",
    "Diesel (Euro 4 Engine and Below)": "Diesel",
    "Diesel-Electric (Euro 5 Engine and Above)": "Diesel-Hybrid",
    "Diesel (Registered as Commercial Vehicle)": "Diesel",
    "Electric": "Electric",
}

VEHICLE_TYPE_MAP = {
    "SUV": "SUV",
    "Luxury Sedan": "Luxury Sedan",
    "Sports Car": "Sports Car",
    "MPV": "MPV",
    "Mid-Sized Sedan": "Sedan",
    "Hatchback": "Hatchback",
    "Stationwagon": "Stationwagon",
    "Others": "Classic/Others",
}

STATUS_MAP = {
    "Available for sale": "Available",
    "Available": "Available",
    "SOLD": "Sold",
    "Sold": "Sold",
    "CLOSED": "Closed",
    "Closed": "Closed",
    "Reserved": "Reserved",
    "N.A.": "Available",
}
DEFAULT_STATUS = "Available"
GOLD_STATUS_VALUES = ["Available", "Sold", "Closed", "Reserved", "Delisted"]

# ---------------------------------------------------------------------------
# Value-score metrics and weights (all "lower is better").
# ---------------------------------------------------------------------------
SCORE_METRICS = [
    ("depreciation", 0.30),
    ("age_years", 0.20),
    ("mileage_km", 0.20),
    ("price_to_omv_ratio", 0.15),
    ("coe_remaining_months", 0.15),
]

# ---------------------------------------------------------------------------
# Lifecycle status sets.
# ---------------------------------------------------------------------------
INACTIVE_STATUSES = ["SOLD", "Sold", "CLOSED", "Closed", "Delisted"]
DELISTABLE_STATUSES = ["Available", "Available for sale", "Reserved"]
SCD_TRACKED_FIELDS = ["price", "depreciation", "status"]
FLOAT_EPSILON = 0.01
