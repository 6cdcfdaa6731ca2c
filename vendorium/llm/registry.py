"""Queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vendorium.llm import bit_sliced, chat, collocations, html_text, language, merkle, mixing, multi_index, ngram_join, packing, sharding, token_files, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    return {
        "op1_best_fit_packing": packing.query,
        "op2_toxicity_ftrl": toxicity.query,
        "op3_tool_call_linking": chat.query,
        "op4_language_ppm": language.query,
        "op5_inverted_multi_index": multi_index.query,
        "op6_token_files": token_files.query,
        "op7_bit_sliced_top_k": bit_sliced.query,
        "op8_feistel_shards": sharding.query,
        "op10_ngram_join": ngram_join.query,
        "op9_source_mixing": mixing.query,
        "op11_merkle_manifest": merkle.query,
        "op12_collocations": collocations.query,
        "op13_html_text": html_text.query,
    }


def statements() -> dict[str, str]:
    return {
        "op7_bit_sliced_top_k": bit_sliced.ORACLE_SQL,
        "op9_source_mixing": mixing.ORACLE_SQL,
        "op11_merkle_manifest": merkle.ORACLE_SQL,
        "op12_collocations": collocations.ORACLE_SQL,
    }
