"""Car-name parsing: brand, model and trim as native Column expressions.

The strategy chain is: strip COE suffixes -> brand (multi-word prefix, then
first word, then raw first word) -> brand-specific model pattern -> engine-code
split -> trim-keyword split -> whole remainder as model.  Everything compiles
to Catalyst expressions (regex, arrays, maps), so it runs inside whole-stage
codegen with no Python in the task.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lookups as LK
from .cache import per_application


# The six ASCII whitespace characters (what ``\s`` matches in Java regex).
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(c: Column) -> Column:
    """Remove leading and trailing whitespace.  ``trim`` only removes spaces;
    ``btrim`` with the whitespace set does the job without a regex scan."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def clean_car_name(car_name: Column) -> Column:
    """FN-1: strip ``(COE till ..)``, ``(New N-yr COE)`` and ``(renewed)`` suffixes."""
    s = F.regexp_replace(strip_ws(F.replace(car_name, F.lit(PART), F.lit(""))), LK.COE_SUFFIX_PATTERN, "")
    return F.regexp_replace(s, LK.RENEWED_SUFFIX_PATTERN, "")


def _model_trim(model: Column, trim: Column) -> Column:
    return F.struct(model.alias("model"), trim.alias("trim"))


def brand_pattern_regex(patterns: list[str]) -> tuple[str, str, str]:
    """One regex per brand with the same answer as trying each pattern in turn.

    Alternative i is ``(.*?)(?:P_i)(.*)``: with DOTALL the tail always
    succeeds, so alternative i matches iff P_i matches somewhere, and the lazy
    prefix finds P_i's leftmost match.  Ordered alternation only falls through
    to P_(i+1) when P_i matches nowhere.  Returns (regex, model_ref, rest_ref)
    replacement templates; groups of alternatives that did not take part are
    empty in the replacement."""
    alts, model_refs, rest_refs = [], [], []
    for i, p in enumerate(patterns):
        alts.append(r"(.*?)(?:" + p + r")(.*)")
        model_refs.append(f"${3 * i + 2}")
        rest_refs.append(f"${3 * i + 3}")
    return r"(?is)^(?:" + "|".join(alts) + r")$", "".join(model_refs), "".join(rest_refs)


#: Parts model and trim within one text; a name must not hold this private-use character
#: (``clean_car_name`` drops it).
PART = "\ue000"


def brand_pattern_mark(brand: Column, rest: Column) -> Column:
    """FN-3: ``model PART trim`` by the first matching brand-specific pattern, in one regex pass;
    without a match the text has no PART.  NULL when the brand has no patterns."""
    out = None
    for b, patterns in LK.BRAND_MODEL_PATTERNS.items():
        rx, model_ref, rest_ref = brand_pattern_regex(patterns)
        cond, val = brand == F.lit(b), F.regexp_replace(rest, rx, model_ref + PART + rest_ref)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def brand_pattern_split(marked: Column) -> Column:
    """FN-3: model and trim of ``brand_pattern_mark``; NULL when no pattern applied."""
    at = F.instr(marked, PART)
    return F.when(at > 0, _model_trim(F.substring(marked, F.lit(1), at - 1),
                                      blank_to_null(strip_ws(F.substring(marked, at + 1, F.lit(1 << 30))))))


_CODE = r"(?:\d+\.\d+[AM]|A|M)"
# On single-spaced words: not starting with an engine code, lazy model words,
# then the first whole-token engine code (or bare A/M).
ENGINE_SPLIT_REGEX = r"^(?!\d+\.\d+[AM](?: |$))(\S+(?: \S+)*?) (" + _CODE + r"(?: .*)?)$"


def single_spaced(rest: Column) -> Column:
    return F.regexp_replace(strip_ws(rest), r"\s+", " ")


def engine_code_mark(words: Column) -> Column:
    """FN-4: ``model PART trim`` split before the first engine-code token (``1.6A``) or a bare
    ``A``/``M`` token that is not the first word; needs a word before it, and a leading engine code
    means no split (then the text has no PART).  ``words`` is ``single_spaced(rest)``.

    One regex pass, no higher-order function, so the projection stays in whole-stage codegen."""
    return F.regexp_replace(words, ENGINE_SPLIT_REGEX, "$1" + PART + "$2")


def engine_code_split(marked: Column) -> Column:
    """Model and trim of ``engine_code_mark``; NULL without a split."""
    at = F.instr(marked, PART)
    return F.when(at > 0, _model_trim(F.substring(marked, F.lit(1), at - 1),
                                      F.substring(marked, at + 1, F.lit(1 << 30))))


TRIM_KEYWORD_REGEX = r"(?i)\b(" + "|".join(LK.TRIM_KEYWORDS) + r")\b"


def trim_keyword_position(rest: Column) -> Column:
    return F.regexp_instr(rest, F.lit(TRIM_KEYWORD_REGEX))


def trim_keyword_split(rest: Column, pos: Column | None = None) -> Column:
    """FN-5: split before the first trim keyword unless it starts the text.
    ``pos`` is ``trim_keyword_position(rest)`` when already computed."""
    pos = trim_keyword_position(rest) if pos is None else pos
    model = blank_to_null(strip_ws(F.substring(rest, F.lit(1), (pos - 1).cast("int"))))
    trim = blank_to_null(strip_ws(F.substring(rest, pos.cast("int"), F.lit(1 << 30))))
    return F.when(pos > 1, _model_trim(model, trim))


@per_application
def _bmt_stages(name_col: str, out: str) -> list[tuple[str, Column]]:
    c = F.col
    stages = [("_clean", clean_car_name(c(name_col))),
              ("_word", F.regexp_replace(c("_clean"), _BRAND_WORD_REGEX, "$1$2"))]
    canon = F.try_element_at(_all_brands_map(), F.lower(c("_word")))
    known_rest = strip_ws(F.substring(c("_clean"), F.length(c("_word")) + 1, 1 << 30))
    # Unknown brand: the raw first word; the rest loses leading whitespace only.
    fallback_rest = F.regexp_extract(c("_clean"), r"(?s)^\s*\S+\s+(.*)$", 1)
    stages.append(("_br", F.struct(
        F.coalesce(canon, c("_word"), F.lit("Unknown")).alias("brand"),
        F.when(c("_word").isNull() | (c("_word") == ""), F.lit(""))
         .when(canon.isNotNull(), known_rest).otherwise(fallback_rest).alias("rest"))))
    stages += [("_brand", c("_br.brand")), ("_rest", c("_br.rest")),
               ("_marked", brand_pattern_mark(c("_brand"), c("_rest"))),
               # Each later strategy looks only at what the earlier ones left.
               ("_engine", F.when(F.coalesce(F.instr("_marked", PART), F.lit(0)) == 0,
                                  engine_code_mark(single_spaced(c("_rest"))))),
               ("_kwpos", F.when(F.instr("_engine", PART) == 0, trim_keyword_position(c("_rest"))))]
    brand, rest = c("_brand"), c("_rest")
    split = F.coalesce(brand_pattern_split(c("_marked")), engine_code_split(c("_engine")),
                       trim_keyword_split(rest, c("_kwpos")),
                       _model_trim(blank_to_null(rest), F.lit(None).cast("string")))
    stages.append(("_split", split))
    empty = rest == ""
    stages.append((out, F.struct(brand.alias("brand"),
                                 F.when(~empty, c("_split.model")).alias("model"),
                                 F.when(~empty, c("_split.trim")).alias("trim"))))
    return stages


def with_brand_model_trim(df: DataFrame, name_col: str = "car_name",
                          out: str = "_bmt") -> DataFrame:
    """FN-6: add ``out`` = struct(brand, model, trim) of ``name_col``.

    Built in stages over attributes: a Column is an expression tree, so using
    ``rest`` or ``words`` several times as expressions would copy and
    re-evaluate them (subexpression elimination does not reach into CASE
    branches).  Each stage yields an attribute that is computed once;
    Catalyst does not collapse a non-cheap projection into a consumer that
    references it several times."""
    for name, col in _bmt_stages(name_col, out):
        df = df.withColumn(name, col)
    return df.drop("_clean", "_word", "_br", "_brand", "_rest", "_marked", "_engine", "_kwpos", "_split")


_COMMERCIAL_WORDS_REGEX = r"(?i)\b(" + "|".join(LK.COMMERCIAL_MODEL_WORDS) + r")\b"

# Multi-word brand as a case-insensitive prefix, else the first word.
_BRAND_WORD_REGEX = ("(?is)^(?:(" + "|".join(re.escape(b.lower()) for b in LK.MULTI_WORD_BRANDS)
                     + r")|\s*(\S+)).*$")


def _all_brands_map() -> Column:
    canon = {"": "Unknown"}
    canon.update({b.lower(): b for b in LK.MULTI_WORD_BRANDS})
    for b in LK.SINGLE_WORD_BRANDS:
        canon.setdefault(b.lower(), b)
    return F.create_map(*[x for k, v in canon.items() for x in (F.lit(k), F.lit(v))])


def brand_only(car_name: Column) -> Column:
    """The brand of a car name without model/trim work (same answer as
    ``with_brand_model_trim(...).brand``).

    Written so that the cleaned name is referenced only twice: this
    expression ends up inlined in a filter pushed into the scan, where
    repeated sub-trees inside CASE branches are evaluated repeatedly."""
    word = F.regexp_replace(clean_car_name(car_name), _BRAND_WORD_REGEX, "$1$2")
    return F.coalesce(F.try_element_at(_all_brands_map(), F.lower(word)), word,
                      F.lit("Unknown"))


@per_application
def commercial_flag(vehicle_type: str = "vehicle_type", car_name: str = "car_name") -> Column:
    """``is_commercial`` over named columns, built once per application."""
    return is_commercial(F.col(vehicle_type), F.col(car_name))


def commercial_brand_regex() -> str:
    """One regex over the cleaned name that is true exactly when the parsed
    brand is in the commercial set, derived from the lookup tables:

    * a multi-word brand prefix (case-insensitive) whose spelling is commercial;
    * otherwise the first word, case-insensitively, when the brand map turns
      it into a commercial spelling (``Sinotruk`` is not: the map spells it
      ``SINOTRUK``);
    * otherwise the raw first word, case-sensitively, for commercial names
      the brand map does not know (they are kept as written).

    A multi-word brand takes precedence over its first word, as in the
    parser, so first words of non-commercial multi-word brands are excluded."""
    canon = {}
    for b in LK.SINGLE_WORD_BRANDS:
        canon.setdefault(b.lower(), b)
    commercial = set(LK.COMMERCIAL_BRANDS)
    multi_low = [b.lower() for b in LK.MULTI_WORD_BRANDS]
    multi_hit = [re.escape(b.lower()) for b in LK.MULTI_WORD_BRANDS if b in commercial]
    multi_miss = [re.escape(b) for b in multi_low if b not in {m.lower() for m in commercial}]
    single_hit = [re.escape(k) for k, v in canon.items() if v in commercial]
    raw_hit = [re.escape(b) for b in LK.COMMERCIAL_BRANDS
               if b.lower() not in canon and b.lower() not in multi_low]
    end = r"(?=\s|$)"
    alts = []
    if multi_hit:
        alts.append("(?i:" + "|".join(multi_hit) + ")")
    guard = "(?!(?i:" + "|".join(multi_miss) + "))" if multi_miss else ""
    if single_hit:
        alts.append(guard + r"\s*(?i:" + "|".join(single_hit) + ")" + end)
    if raw_hit:
        alts.append(guard + r"\s*(?:" + "|".join(raw_hit) + ")" + end)
    return "(?s)^(?:" + "|".join(alts) + ")"


def is_commercial(vehicle_type: Column, car_name: Column, brand: Column | None = None) -> Column:
    """FIL-1: commercial vehicle type, commercial brand (case-sensitive) or a
    commercial model word anywhere in the name.  Never NULL.  ``brand``
    defaults to ``brand_only(car_name)``."""
    # Without a parsed brand, one regex over the cleaned name decides the
    # brand test, so the predicate (pushed into the scan, where a fused filter
    # gets no subexpression elimination) evaluates the cleaned name once.
    brand_hit = (clean_car_name(car_name).rlike(commercial_brand_regex()) if brand is None
                 else brand.isin(*LK.COMMERCIAL_BRANDS))
    parts = [vehicle_type.isin(*LK.COMMERCIAL_VEHICLE_TYPES), brand_hit,
             car_name.rlike(_COMMERCIAL_WORDS_REGEX)]
    return reduce(lambda a, b: a | b, [F.coalesce(p, F.lit(False)) for p in parts])
