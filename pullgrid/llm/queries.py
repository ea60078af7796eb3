"""The registered queries of this subpackage and their SQL restatements."""

from __future__ import annotations

from pullgrid.llm import (
    bpe,
    latent_leaks,
    line_dedup,
    ngram_join,
    norm_search,
    packing,
    prefix_trie,
    quality_rules,
    secret_links,
    sharding,
    surrogates,
    token_files,
    transcripts,
)

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_ngram_join": ngram_join.query,
    "op3_transcripts": transcripts.query,
    "op4_surrogates": surrogates.query,
    "op5_token_files": token_files.query,
    "op6_quality_rules": quality_rules.query,
    "op7_bpe": bpe.query,
    "op8_secret_links": secret_links.query,
    "op9_latent_leaks": latent_leaks.query,
    "op10_sharding": sharding.query,
    "op11_norm_search": norm_search.query,
    "op12_best_fit": packing.query,
    "op13_prefix_trie": prefix_trie.query,
}

ORACLE = {
    "op1_line_dedup": line_dedup.SQL,
    "op2_ngram_join": ngram_join.SQL,
    "op6_quality_rules": quality_rules.SQL,
    "op11_norm_search": norm_search.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
