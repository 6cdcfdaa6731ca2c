from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

# `score`, `size`, `shard`, `component_id` and `found` clash with names that operators use themselves.
FIELDS = [("doc_id", LongType()), ("text", StringType()), ("lang", StringType()), ("source", StringType()), ("n_chars", LongType()), ("score", StringType()), ("size", StringType()), ("component", StringType()), ("found", StringType())]
SCHEMA = StructType([StructField(name, kind) for name, kind in FIELDS])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]); other columns hold clashing names."""

    def make(rows):
        full = []
        for row in rows:
            doc, text, lang, source = (*row, *(None,) * (4 - len(row)))
            full.append((doc, text, lang, source, None, "x", "y", "z", "w"))
        return spark.createDataFrame(full, SCHEMA)

    return make


AWKWARD = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \n\t ", None, "a"),
    (4, "one two three four five six seven eight nine ten", "en", "b"),
    (4, "one two three four five six seven eight nine ten", "en", "b"),
    (5, "one two three four five six seven eight nine ten", "en", "b"),
    (None, "zwei drei vier fünf sechs sieben acht neun zehn elf", "de", "b"),
    (6, "word " * 30_000, "en", "a"),
    (7, "<|endoftext|> x<|startoftext|>y É é", "fr", ""),
    (8, "12345 --- 678", None, "c"),
]


@pytest.fixture(scope="session")
def awkward(make_docs):
    return make_docs(AWKWARD)


@pytest.fixture(scope="session")
def empty(make_docs):
    return make_docs([])
