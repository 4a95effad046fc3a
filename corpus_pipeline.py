"""A corpus pipeline of the operators in ``lumbung.llm``.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next stage's documents. All but the last return
the columns of ``docs``, whatever other names it has. Rows with nulls, empty texts, repeated rows and empty tables are handled
as the operators' docstrings say. There is no oracle SQL: trained classifiers, minhashes and a
Viterbi search have none; tests/llm/test_pipeline.py holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm import decontamination, language, minhash, secrets, sentencepiece_codec
from lumbung.llm.common import KEY, packed, unpacked
from lumbung.sources.staging import stage

CONFIDENT = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages: texts without a letter or without a clear language go.

    Without any labelled document nothing can be learned, and only texts without a letter go.
    """
    model = language.train(docs.filter(language.fold(5) != 0))
    if model is None:
        return docs.filter(language.has_letter(F.col("text")))
    found = language.with_language(docs, model)
    return unpacked(found.filter((F.col("lang_pred") != "und") & (F.col("score") >= CONFIDENT)), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies; repeated rows count as one."""
    kept = minhash.near_duplicates(docs).filter("kept").select(*KEY)
    return unpacked(packed(docs).join(kept, KEY, "left_semi").dropDuplicates(KEY), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts stay; of rows that share a doc_id, or have none, each is judged by its own text;
    repeated rows go or stay alike; without a benchmark all stay. Long texts are searched whole.
    """
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark.

    Null and empty texts stay as they are, repeated rows change alike, an empty table stays empty; a very
    long text is scanned whole.
    """
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, and whether the ids decode to the text; a row for each row of ``docs``.

    A null text has no ids and n_tokens 0, as in the operator; an empty table gives none; other columns are left out.
    """
    encoded = sentencepiece_codec.encode(docs, sentencepiece_codec.load(), "doc_id", "lang", "source", check=True)
    return encoded.withColumn("n_tokens", F.coalesce(F.size("ids"), F.lit(0)).cast("long"))


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret scans", secret_scan),
    ("SentencePiece encoding and decoding", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every intermediate result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
