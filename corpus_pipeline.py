"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns the columns of documents;
the last returns packed pieces. Between stages the rows are written as Parquet. Columns that a stage does not need
may have any names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vendorium.llm import language, mixing, ngram_join, packing, toxicity
from vendorium.llm.scratch import Scratch
from vendorium.llm.shipping import ship
from vendorium.llm.tokens import default_vocabulary, read_vocabulary

REMEMBERED_WORDS = 50_000  # fewer than the packing query: workers of the stages before still stand beside those that pack
NEEDED = ("doc_id", "text", "lang", "source")
ORACLE_SQL = None  # learned models and hashed draws have no SQL form


def _with_plain_names(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run `work` with every column that no stage needs under a number, and give the names back."""
    names = docs.columns
    plain = [name if name in NEEDED else f"given_{place}" for place, name in enumerate(names)]
    return work(docs.toDF(*plain)).select(*plain).toDF(*names)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents whose chance of being toxic is one half or more. Null and empty texts stay."""
    ship(spark)
    weights = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = toxicity.score_column(weights)
    return _with_plain_names(docs, lambda d: d.withColumn("score", score(F.col("text").cast("string"))).filter("score < 0.5"))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents in no known language: without letters, or that no language's model codes in fewer bits than
    the bytes have. A language other than the one declared is no reason. Without any language to learn from, all stay.
    """
    ship(spark)
    languages = language.train(docs)
    if not languages.names:
        return docs
    found = language.predict_column(languages)(F.col("text").cast("string"))
    known = (F.col("found.lang_pred") != language.UNKNOWN) & (F.col("found.bits_per_byte") < language.RAW_BITS)
    return _with_plain_names(docs, lambda d: d.withColumn("found", found).filter(known))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group with at least 80 % of five-word shingles in common, directly or by others."""
    return _with_plain_names(docs, lambda d: ngram_join.keep_one(d, words=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the words of each source come near its target."""
    return _with_plain_names(docs, lambda d: mixing.emit(mixing.mix_documents(d), d.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return packing.pack_documents(docs, read_vocabulary(default_vocabulary()), known=REMEMBERED_WORDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the table before is deleted once the next one is written."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
