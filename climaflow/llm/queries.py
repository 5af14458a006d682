"""Registered queries of the operators and the SQL that some are checked against."""

from __future__ import annotations

from .bpe_automaton import op11_bpe_automaton
from .chat_format import OP9_SQL, op9_columnar_chat
from .decontaminate import op2_spaced_seed_overlaps
from .html_text import op8_text_density
from .jaccard_join import op6_ngram_jaccard
from .lm_score import op7_log_frequency_lm
from .mixing import op1_raked_mixture
from .quality_model import op4_boosted_quality
from .quality_rules import op3_quality_rules
from .sharding import op5_interleaved_shards
from .spelling import OP13_SQL, op13_spelling_variants
from .url_rules import OP10_SQL, op10_url_rules
from .whitening import op12_embedding_whitening

QUERIES = {
    "op1_raked_mixture": op1_raked_mixture,
    "op2_spaced_seed_overlaps": op2_spaced_seed_overlaps,
    "op3_quality_rules": op3_quality_rules,
    "op4_boosted_quality": op4_boosted_quality,
    "op5_interleaved_shards": op5_interleaved_shards,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_log_frequency_lm": op7_log_frequency_lm,
    "op8_text_density": op8_text_density,
    "op9_columnar_chat": op9_columnar_chat,
    "op10_url_rules": op10_url_rules,
    "op11_bpe_automaton": op11_bpe_automaton,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE = {"op9_columnar_chat": OP9_SQL, "op10_url_rules": OP10_SQL, "op13_spelling_variants": OP13_SQL}
