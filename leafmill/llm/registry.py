"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontaminate, html_text, lm_score, merkle, mixing, near_dup, near_vectors, pii, quality, secrets, topk, url_rules, whitening

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_top_k": topk.op2_top_k,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_url_filter": url_rules.op4_url_filter,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_near_duplicates": near_dup.op6_near_duplicates,
    "op7_pii": pii.op7_pii,
    "op8_lm_score": lm_score.op8_lm_score,
    "op9_main_text": html_text.op9_main_text,
    "op10_quality": quality.op10_quality,
    "op11_merkle": merkle.op11_merkle,
    "op12_whitening": whitening.op12_whitening,
    "op13_near_vectors": near_vectors.op13_near_vectors,
}
ORACLES = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op2_top_k": topk.OP2_SQL,
    "op3_decontaminate": decontaminate.OP3_SQL,
    "op4_url_filter": url_rules.OP4_SQL,
    "op5_secret_scan": secrets.OP5_SQL,
    "op11_merkle": merkle.OP11_SQL,
    "op13_near_vectors": near_vectors.OP13_SQL,
}
