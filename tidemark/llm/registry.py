"""The registered queries of the operators, and their DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import ann, bpe, mixing, neardup, pii, quality, repair, search, secrets, simhash, suffixdedup, trie, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op10_search": search.query,
    "op11_repair": repair.query,
    "op12_simhash": simhash.query,
    "op13_prefix_trie": trie.query,
    "op1_suffix_dedup": suffixdedup.query,
    "op2_warc": warc.query,
    "op3_quality": quality.query,
    "op4_secrets": secrets.query,
    "op5_near_duplicates": neardup.query,
    "op6_pii": pii.query,
    "op7_neighbours": ann.query,
    "op8_mixing": mixing.query,
    "op9_bpe": bpe.query,
}

ORACLE: dict[str, str] = {
    "op11_repair": repair.ORACLE,
    "op13_prefix_trie": trie.ORACLE,
    "op2_warc": warc.ORACLE,
}
