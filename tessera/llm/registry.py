"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from tessera.llm.bpe import op1_bpe
from tessera.llm.cross_tokens import op11_cross_tokens
from tessera.llm.decontaminate import op10_decontaminate
from tessera.llm.language_id import op2_language_id
from tessera.llm.licenses import op3_licenses
from tessera.llm.lm_score import op4_lm_score
from tessera.llm.near_dedup import op8_near_dedup
from tessera.llm.ngram_join import OP13_SQL, op13_ngram_join
from tessera.llm.phrases import OP12_SQL, op12_phrases
from tessera.llm.pii import op5_pii
from tessera.llm.quality import op7_quality
from tessera.llm.token_counts import op6_token_counts
from tessera.llm.url_rules import OP9_SQL, op9_url_rules


def queries() -> dict:
    listed = (
        op1_bpe, op2_language_id, op3_licenses, op4_lm_score, op5_pii,
        op6_token_counts, op7_quality, op8_near_dedup, op9_url_rules, op10_decontaminate, op11_cross_tokens, op12_phrases, op13_ngram_join,
    )
    return {f.__name__: f for f in listed}


def oracle_sql() -> dict[str, str]:
    return {"op9_url_rules": OP9_SQL, "op12_phrases": OP12_SQL, "op13_ngram_join": OP13_SQL}
