"""Queries of this package and, where SQL can say the same, their SQL."""

from __future__ import annotations

from . import ann, chat_format, html_extract, minhash_index, mixing, ngram_join, packing, prefix_trie, quality_rules, resampling, sharding, toxicity, url_filter

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_chat_format": chat_format.op2_chat_format,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_packing": packing.op5_packing,
    "op6_ann": ann.op6_ann,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_sharding": sharding.op8_sharding,
    "op9_html_extract": html_extract.op9_html_extract,
    "op10_mixing": mixing.op10_mixing,
    "op11_resampling": resampling.op11_resampling,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_minhash_index": minhash_index.op13_minhash_index,
}

ORACLE: dict[str, str] = {
    "op2_chat_format": chat_format.CHAT_SQL,
    "op10_mixing": mixing.mixing_sql(),
    "op11_resampling": resampling.RESAMPLING_SQL,
    "op12_prefix_trie": prefix_trie.TRIE_SQL,
    "op13_minhash_index": minhash_index.NEAR_COPIES_SQL,
}
