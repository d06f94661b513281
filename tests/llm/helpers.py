"""Small tables with every awkward case, and plain versions of text rules."""

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = "the quick brown fox jumps over the lazy dog and runs away from it " * 700


def lower(text):
    return (text or "").translate(LOWER)


def words(text):
    return WORDS.findall(lower(text))


def awkward(spark, extra=""):
    """Nulls in every column, empty and very long texts, repeated rows, shared ids, odd white
    space, and `extra` columns that clash with names the operators add."""
    text = "Ein Satz mit ein paar Worten und noch einem Wort mehr."
    rows = [
        (1, text, "de", "a", 10),
        (2, text.upper().replace("Ü", "ü"), "de", "a", 10),
        (3, None, "en", "b", None),
        (4, "", None, None, 0),
        (5, " \t\n ", "en", "a", 4),
        (6, LONG, "en", "a", len(LONG)),
        (7, LONG + "once", "en", "hot", len(LONG)),
        (7, "another text under a known number", "en", "hot", 9),
        (None, "no number at all here", "en", "hot", 5),
        (None, "no number at all here", "en", "hot", 5),
        (None, None, None, None, None),
        (8, "123 456 !!", "en", "hot", 7),
        (9, text, "de", "a", 10),
        (9, text, "de", "a", 10),
        (10, "Été 中文 한국어 <|endoftext|>  two  spaces ", "fr", "b", 7),
        (11, "word", "fr", "b", 4),
        (12, "word", None, "b", 4),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in extra.split():
        df = df.withColumn(name, df["doc_id"])
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
