"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from tripmart.llm import (
    bpe,
    collocations,
    fingerprints,
    host_rules,
    lexical,
    licenses,
    mixing,
    near_duplicates,
    perspectives,
    substrings,
    top_k,
    toxicity,
    url_filter,
)

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_substrings": substrings.op2_substrings,
    "op3_licences": licenses.op3_licences,
    "op4_perspectives": perspectives.op4_perspectives,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_bpe": bpe.op6_bpe,
    "op7_top_k": top_k.op7_top_k,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_host_rules": host_rules.op9_host_rules,
    "op10_near_duplicates": near_duplicates.op10_near_duplicates,
    "op11_lexical_search": lexical.op11_lexical_search,
    "op12_collocations": collocations.op12_collocations,
    "op13_fingerprints": fingerprints.op13_fingerprints,
}

SQL = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op2_substrings": substrings.OP2_SQL,
    "op3_licences": licenses.OP3_SQL,
    "op4_perspectives": perspectives.OP4_SQL,
    "op7_top_k": top_k.OP7_SQL,
    "op9_host_rules": host_rules.OP9_SQL,
    "op11_lexical_search": lexical.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
}
