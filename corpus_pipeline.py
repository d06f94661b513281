"""A corpus made ready for training: the stages, and their run over `documents`.

Each stage takes all that its predecessor kept, written as Parquet and read again, so a lost
executor costs no earlier stage. The stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesync.llm.common import table
from tablesync.llm.exact_dedup import exact_duplicates
from tablesync.llm.langid import UNKNOWN, predict_languages
from tablesync.llm.minhash import near_duplicates, text_key
from tablesync.llm.mixing import mix_sources
from tablesync.llm.packing import pack_documents
from tablesync.sinks.files import SharedFiles, new_path, stage, staging_scope

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document whose language is less sure than this is rejected.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: null texts, texts without letters and undecided ones go.

    Null ids and repeated rows are judged each; an empty table gives an empty table.
    """
    told = predict_languages(docs)
    sure = (told["lang_pred"] != UNKNOWN) & (told["score"] >= LEAST_SCORE)
    return told.filter(sure).select(*COLUMNS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (A-Z lower-cased), the one with the largest doc_id stays.

    A null id is smaller than any; of rows that share id and text one stays; null texts count as empty.
    """
    return exact_duplicates(docs).filter("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles, the one with the smallest doc_id stays.

    Documents without an id stay.
    """
    gone = near_duplicates(docs, words=5, percent=80).filter("not kept").select("doc_id", "text_key")
    keyed = docs.withColumn("text_key", text_key())
    return keyed.join(stage(gone, "near-duplicates"), ["doc_id", "text_key"], "left_anti").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, shuffled.

    A null source, or one without a weight of its own, is of the rest; repeated rows are drawn alike.
    """
    return mix_sources(docs).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents with their places in sequences, one row a piece.

    A null text is an empty one, with the end's id alone; an empty table gives an empty table.
    """
    return pack_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing", mixing),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from `documents` as it is."""
    docs, held = table(spark, sf_dir, "documents").select(*COLUMNS), None
    for name, apply in STAGES[:-1]:
        path = new_path(spark, "pipeline-" + name.replace(" ", "-"))
        with staging_scope(spark):  # what the stage wrote for itself goes once its result is written
            result = apply(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if held is not None:
            SharedFiles(spark, held).delete_root()
        held = path
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned models and hashed signatures are beyond SQL; tests compare with brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
