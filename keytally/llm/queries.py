"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from keytally.llm import embedding_dedup, hard_negatives, lexical_search
from keytally.llm.ctw_scoring import op4_lm_scoring
from keytally.llm.embedding_dedup import op10_embedding_dedup
from keytally.llm.fingerprints import op7_fingerprints
from keytally.llm.hard_negatives import op13_hard_negatives
from keytally.llm.lexical_search import op12_lexical_search
from keytally.llm.quality_cnn import op1_quality
from keytally.llm.secrets import op2_secrets
from keytally.llm.sentencepiece_codec import op8_sentencepiece
from keytally.llm.simhash_dedup import op3_simhash_dedup
from keytally.llm.source_mix import op6_source_mix
from keytally.llm.suffix_dedup import op5_suffix_dedup
from keytally.llm.token_counts import op11_token_counts
from keytally.llm.toxicity import op9_toxicity

QUERIES = {
    "op1_quality": op1_quality,
    "op2_secrets": op2_secrets,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_source_mix": op6_source_mix,
    "op7_fingerprints": op7_fingerprints,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_toxicity": op9_toxicity,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_lexical_search": op12_lexical_search,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op10_embedding_dedup": embedding_dedup.ORACLE,
    "op12_lexical_search": lexical_search.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
