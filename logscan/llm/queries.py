"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from logscan.llm.decontamination import OP3_SQL, op3_decontamination
from logscan.llm.language_model import op4_lm_scoring
from logscan.llm.line_dedup import op7_line_dedup
from logscan.llm.mixing import op2_mixing
from logscan.llm.ngram_join import OP8_SQL, op8_ngram_jaccard
from logscan.llm.preferences import OP5_SQL, op5_preferences
from logscan.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from logscan.llm.sharding import op1_sharding
from logscan.llm.topk import OP6_SQL, op6_topk
from logscan.llm.toxicity import op9_toxicity
from logscan.llm.url_filters import OP12_SQL, op12_url_filters
from logscan.llm.warc import OP10_SQL, op10_merkle_audit
from logscan.llm.whitening import op11_whitening

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_mixing": op2_mixing,
    "op3_decontamination": op3_decontamination,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_preferences": op5_preferences,
    "op6_topk": op6_topk,
    "op7_line_dedup": op7_line_dedup,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_toxicity": op9_toxicity,
    "op10_merkle_audit": op10_merkle_audit,
    "op11_whitening": op11_whitening,
    "op12_url_filters": op12_url_filters,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": OP3_SQL,
    "op5_preferences": OP5_SQL,
    "op6_topk": OP6_SQL,
    "op8_ngram_jaccard": OP8_SQL,
    "op10_merkle_audit": OP10_SQL,
    "op12_url_filters": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
