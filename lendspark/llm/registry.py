"""Queries of this subpackage and their SQL."""

from . import op1_toxicity, op2_warc, op3_lm, op4_vafile, op5_ngram_join, op6_langid, op7_mix, op8_tokens, op9_license, op10_decontaminate
from . import op11_simhash, op12_trie, op13_spelling

MODULES = [
    op1_toxicity, op2_warc, op3_lm, op4_vafile, op5_ngram_join, op6_langid, op7_mix, op8_tokens, op9_license, op10_decontaminate,
    op11_simhash, op12_trie, op13_spelling,
]


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: s for m in MODULES for name, s in m.SQL.items()}
