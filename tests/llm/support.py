"""Fixture tables and brute-force versions shared by the operator tests."""

import re

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "c0 string, row string, node long, n long, bin_id long, _q string")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30000))
BASE = "the quick brown fox jumps over the lazy dog and runs far away from here today"


def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows; extra columns with working names."""
    near = BASE.replace("lazy", "tired")
    texts = [
        (1, BASE + "\nsecond line of this one here"), (2, None), (3, ""), (4, " \t\n \x0b"), (5, "one"),
        (6, LONG), (7, BASE + "\nsecond line of this one here"), (8, near), (8, near), (9, "A B a b A B a b"),
        (10, "mail jo.d+x@mail.example.org, ip 10.0.0.256 or 10.0.0.25 card 4111 1111 1111 1111"),
        (11, "call +1 (415) 555-0132 now é ü"), (None, "no id here at all"), (12, LONG + " tail"),
        (13, "x" * 50000), (14, "one"), (15, "▁ mark <s> </s> <|endoftext|>"),
    ]
    return [(d, t, None if i % 5 == 4 else "en", None if i % 6 == 5 else f"s{i % 3}", len(t or ""),
             "x", "y", i, i, i, "z") for i, (d, t) in enumerate(texts)]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOC_SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def words(text):
    """Words of a text, A-Z lower-cased, as bytes."""
    return [w.lower() for w in WORDS.findall((text or "").encode())]


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
