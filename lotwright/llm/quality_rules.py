"""Quality rules: base counts plus distribution divergence from a language's own profile.

Every document gets two histograms: character classes, and common function
words.  The reference of a language is the sum of the histograms of all its
documents that pass the base rules, so it is measured on the whole corpus.  A
document is rejected when the Jensen-Shannon distance (base 2, 0..1) of either
histogram from its language's reference is above the limit.  Minimum-length
guards, in characters and in words, skip a histogram that is too short to
judge.  A text without any common word is judged like any other.  Short texts
are farther from their reference by chance alone, so the limit of the word
histogram falls with the number of words.

Only DataFrame functions run on the main path.

Defined results: null text is empty (no words, so ``base_failed``); a null
language is a language of its own; a language with fewer than
``min_reference_docs`` good documents gives no divergence verdict; repeated
rows are judged one by one; an empty table gives an empty result; columns of
the input never clash with working columns, which live in one struct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize

# Frequent function words of English, French, German and Spanish.
COMMON_WORDS = [
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "was", "for", "on", "with", "as", "at",
    "de", "la", "le", "et", "les", "des", "en", "un", "une", "est", "pour", "que", "dans", "du", "qui",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "auf", "ist", "im", "dem", "nicht",
    "el", "y", "los", "se", "del", "las", "por", "con", "no", "para", "al",
]

MIN_WORDS = 50            # base rule
MAX_REPEAT_PERCENT = 50   # base rule
MIN_CHARS = 200           # guard of the character histogram, in word characters
MIN_HISTOGRAM_WORDS = 50  # guard of the word histogram, in words of the text
MIN_REFERENCE_DOCS = 20   # guard of a language's reference
MAX_CHAR_DISTANCE = 0.35
# Word limit: SHORT, falling with 1 / sqrt(words) to LONG.  On sf0.1 documents of which 8 % or more
# are common words stay below 0.30 and below 3.4 / sqrt(words), but for a few under 80 words; a text
# without common words is 0.314 to 0.316 away, and long texts of another language 0.29 to 0.42.
SHORT_WORD_DISTANCE = 0.30
LONG_WORD_DISTANCE = 0.25
WORD_SPREAD = 3.6

#: Runs without ASCII punctuation; the symbols of the base rule are no punctuation.
NOT_PUNCTUATION = r"[^!\\x22\\x27()+,./:;=?@\\x5B\\x5C\\x5D^_`{}~-]+"
_WORDS = r"array_remove(split({t}, '[\\x20\\x09-\\x0D]+'), '')"


def _steps(text: str) -> list[dict[str, str]]:
    """Feature expressions in layers; each layer may use the columns before it."""
    in_words = ", ".join(f"'{w}'" for w in COMMON_WORDS)
    keys = ", ".join(f"hash('{w}')" for w in COMMON_WORDS)
    at = "(_q_sorted[{0}] & (_q_unit - 1))"
    words = " AND ".join(f"_q_words[{at.format('i')} + {d}] = _q_words[{at.format('i - 1')} + {d}]" for d in range(3))
    return [
        {"_q_text": text},
        {"_q_words": _WORDS.format(t="_q_text"),
         "_q_lines": r"filter(split(_q_text, '\n', -1), l -> l RLIKE '[^\\x20\\x09-\\x0D]')"},
        {"_q_n": "CAST(size(_q_words) AS BIGINT)"},
        # A window's hash and its position share one long, so equal windows
        # meet by a sort of plain longs; the words themselves are then compared.
        {"_q_bits": "CAST(ceil(log2(_q_n + 2)) AS INT)"},
        {"_q_unit": "shiftleft(1L, _q_bits)"},
        # A window's hash and its position share one long, so equal windows
        # become neighbours by a sort of plain longs; their words are then compared.
        {"_q_sorted": "sort_array(IF(_q_n >= 3, transform(sequence(0L, _q_n - 3), p -> "
                      "(xxhash64(_q_words[p], _q_words[p + 1], _q_words[p + 2]) & -_q_unit) | p), "
                      "CAST(array() AS ARRAY<BIGINT>)))"},
        {"_q_same": "IF(_q_n >= 4, filter(sequence(1, CAST(_q_n AS INT) - 3), i -> "
                    f"shiftright(_q_sorted[i] ^ _q_sorted[i - 1], _q_bits) = 0 AND {words}), "
                    "CAST(array() AS ARRAY<INT>))"},
        {"_q_at": f"sort_array(array_distinct(flatten(transform(_q_same, i -> array({at.format('i')}, {at.format('i - 1')})))))"},
        {"_q_repeat": "IF(size(_q_at) = 0, 0L, aggregate(transform(_q_at, (p, i) -> "
                      "least(3L, coalesce(get(_q_at, i + 1) - p, 3L))), 0L, (s, d) -> s + d))",
         # Common words as sorted hashes (they differ): equal words are runs.
         "_q_common": f"sort_array(transform(filter(_q_words, w -> w IN ({in_words})), w -> hash(w)))",
         "_q_word_chars": "CAST(length(array_join(_q_words, '')) AS BIGINT)",
         "_q_symbols": r"CAST(length(regexp_replace(_q_text, '[^#*$%&|<>]+', '')) AS BIGINT)",
         "_q_upper": "CAST(length(regexp_replace(_q_text, '[^A-Z]+', '')) AS BIGINT)",
         "_q_digit": "CAST(length(regexp_replace(_q_text, '[^0-9]+', '')) AS BIGINT)",
         "_q_wide": r"CAST(length(regexp_replace(_q_text, '[\\x00-\\x7F]+', '')) AS BIGINT)",
         "_q_punct": f"CAST(length(regexp_replace(_q_text, '{NOT_PUNCTUATION}', '')) AS BIGINT)",
         "_q_dup_lines": "CAST(size(_q_lines) - size(array_distinct(_q_lines)) AS BIGINT)"},
        {"_q_failed": f"_q_n < {MIN_WORDS} OR 100 * _q_repeat > {MAX_REPEAT_PERCENT} * _q_n",
         # Lower-case letters and whatever is left are the last class.
         "_q_chars": "array(_q_upper, _q_digit, _q_symbols, _q_wide, _q_punct, "
                     "_q_word_chars - _q_upper - _q_digit - _q_symbols - _q_wide - _q_punct)",
         "_q_runs": "IF(size(_q_common) = 0, CAST(array() AS ARRAY<INT>), filter(sequence(0, size(_q_common) - 1), "
                    "i -> i = 0 OR _q_common[i] <> _q_common[i - 1]))"},
        {"_q_kinds": "transform(_q_runs, i -> _q_common[i])"},
        {"_q_hits": f"concat(transform(array({keys}), k -> CAST(coalesce("
                    "coalesce(get(_q_runs, CAST(array_position(_q_kinds, k) AS INT)), size(_q_common)) "
                    "- get(_q_runs, CAST(array_position(_q_kinds, k) AS INT) - 1), 0) AS BIGINT)), "
                    "array(_q_n - size(_q_common)))"},
    ]


def features(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The ``carry`` columns and a struct ``_q`` of base counts and histograms."""
    named = [f"`c{i}`" for i in range(len(carry))]
    out = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(carry)],
                      F.coalesce(docs["text"], F.lit("")).alias("_q_in"),
                      F.coalesce(docs["lang"], F.lit("")).alias("_q_lang"))
    for layer in _steps("_q_in"):
        out = out.selectExpr("*", *[f"{e} AS {n}" for n, e in layer.items()])
    return out.selectExpr(*named, """named_struct('lang', _q_lang, 'n_words', _q_n,
        'word_chars', _q_word_chars, 'n_symbols', _q_symbols, 'n_dup_lines', _q_dup_lines,
        'n_repeat_words', _q_repeat, 'base_failed', _q_failed, 'n_common', size(_q_common),
        'chars', _q_chars, 'hits', _q_hits) AS _q""")


def references(measured: DataFrame) -> DataFrame:
    """One row per language: summed histograms of the documents that pass the base rules."""
    n_bins = len(COMMON_WORDS) + 1
    sums = measured.where("NOT _q.base_failed").groupBy(F.col("_q.lang").alias("_r_lang")).agg(
        F.count("*").alias("_r_docs"), F.sum("_q.word_chars").alias("_r_n_chars"), F.sum("_q.n_words").alias("_r_n_words"),
        F.array(*[F.sum(F.col("_q.chars")[i]) for i in range(6)]).alias("_r_chars"),
        F.array(*[F.sum(F.col("_q.hits")[i]) for i in range(n_bins)]).alias("_r_hits"))
    return sums.where(F.col("_r_docs") >= MIN_REFERENCE_DOCS)


def _distance(counts: str, total: str, reference: str, reference_total: str) -> str:
    """SQL text of the Jensen-Shannon distance of two count arrays with their totals."""
    part = "IF({0} > 0, {0} * log2(2 * {0} / ({0} + {1})), 0D)"
    shares = (f"zip_with(transform({counts}, x -> x / greatest({total}, 1L)), "
              f"transform({reference}, x -> x / greatest({reference_total}, 1L)), "
              f"(p, q) -> {part.format('p', 'q')} + {part.format('q', 'p')})")
    return f"sqrt(greatest(aggregate({shares}, 0D, (s, x) -> s + x) / 2, 0D))"


def assess(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` columns named c0.., then ``_q`` (counts) and ``_v`` (distances, ``kept``).

    The measured rows are written once: they feed both the references (one row
    per language, exact integer sums with partial aggregation) and the verdict.
    The reference table has one fixed-size row per language; whether it is
    broadcast is Spark's choice by its written size.
    """
    measured = materialize(features(docs, carry), "quality", "zstd")       # it may hold whole texts
    refs = materialize(references(measured), "quality-ref")
    joined = measured.join(refs, measured["_q"]["lang"] == refs["_r_lang"], "left")
    judged = joined.selectExpr(
        "*",
        f"IF(_r_docs IS NULL OR _q.word_chars < {MIN_CHARS}, 0D, {_distance('_q.chars', '_q.word_chars', '_r_chars', '_r_n_chars')}) AS _d_char",
        f"IF(_r_docs IS NULL OR _q.n_words < {MIN_HISTOGRAM_WORDS}, 0D, {_distance('_q.hits', '_q.n_words', '_r_hits', '_r_n_words')}) AS _d_word")
    word_limit = f"least({SHORT_WORD_DISTANCE}D, greatest({LONG_WORD_DISTANCE}D, {WORD_SPREAD}D / sqrt(greatest(_q.n_words, 1L))))"
    return judged.selectExpr(*[f"c{i}" for i in range(len(carry))], "_q", f"""named_struct('char_distance', _d_char, 'word_distance', _d_word,
        'kept', NOT _q.base_failed AND _d_char <= {MAX_CHAR_DISTANCE} AND _d_word <= {word_limit}) AS _v""")


def report(docs: DataFrame) -> DataFrame:
    """Per document: base counts, ``base_failed``, the two distances and ``kept``."""
    return assess(docs, ["doc_id"]).selectExpr(
        "c0 AS doc_id", "_q.n_words", "_q.word_chars", "_q.n_symbols", "_q.n_dup_lines", "_q.n_repeat_words",
        "_q.base_failed", "_v.kept", "round(_v.char_distance, 6) AS char_distance",
        "round(_v.word_distance, 6) AS word_distance")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    good = assess(docs, docs.columns).where("_v.kept")
    return good.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
