"""Queries of the corpus operators and their oracle SQL."""

from __future__ import annotations

from tideline.llm.byte_bpe import op5_byte_bpe
from tideline.llm.decontaminate import OP9_SQL, op9_decontaminate
from tideline.llm.media import op10_media_columns
from tideline.llm.ngram_join import OP2_SQL, op2_ngram_join
from tideline.llm.pii import op8_pii_surrogates
from tideline.llm.pitman_yor import op1_pitman_yor
from tideline.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from tideline.llm.secret_scan import OP7_SQL, op7_secret_scan
from tideline.llm.sharding import op12_sharding
from tideline.llm.token_file import op4_token_file
from tideline.llm.toxicity import op6_toxicity
from tideline.llm.url_filter import OP3_SQL, op3_url_filter
from tideline.llm.whitening import op13_whitening


OPERATORS = (
    op1_pitman_yor, op2_ngram_join, op3_url_filter, op4_token_file, op5_byte_bpe, op6_toxicity, op7_secret_scan, op8_pii_surrogates,
    op9_decontaminate, op10_media_columns, op11_prefix_trie, op12_sharding, op13_whitening,
)


def queries():
    return {f.__name__: f for f in OPERATORS}


def oracle_sql():
    return {"op2_ngram_join": OP2_SQL, "op3_url_filter": OP3_SQL, "op7_secret_scan": OP7_SQL, "op9_decontaminate": OP9_SQL, "op11_prefix_trie": OP11_SQL}
