"""The registered queries of this subpackage, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import chat, jaccard, leaks, lines, mixing, nearest, phrases, pii, quality, ranked, reputation, substrings, tokens
from siltstone.llm.oracle import ORACLE as ORACLE
from siltstone.session import tune


def _tuned(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_leaks": leaks.op2_leaks,
    "op3_pii": pii.op3_pii,
    "op4_chat": chat.op4_chat,
    "op5_lines": lines.op5_lines,
    "op6_jaccard": jaccard.op6_jaccard,
    "op7_tokens": tokens.op7_tokens,
    "op8_nearest": nearest.op8_nearest,
    "op9_mix": mixing.op9_mix,
    "op10_substrings": substrings.op10_substrings,
    "op11_search": ranked.op11_search,
    "op12_phrases": phrases.op12_phrases,
    "op13_urls": reputation.op13_urls,
}
QUERIES = {name: _tuned(query) for name, query in QUERIES.items()}
