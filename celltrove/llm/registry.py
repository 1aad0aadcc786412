"""Queries and SQL of this subpackage, for the entry module."""

from __future__ import annotations

from . import bpe, chat, decontaminate, licenses, lm, minhash, negatives, packing, pii, suffix_dedup, topk, toxicity


def queries() -> dict:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_decontaminate": decontaminate.op2_decontaminate,
        "op3_topk": topk.op3_topk,
        "op4_chat": chat.op4_chat,
        "op5_minhash": minhash.op5_minhash,
        "op6_byte_bpe": bpe.op6_byte_bpe,
        "op7_pii": pii.op7_pii,
        "op8_licenses": licenses.op8_licenses,
        "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
        "op10_lm_score": lm.op10_lm_score,
        "op11_negatives": negatives.op11_negatives,
        "op12_packing": packing.op12_packing,
    }


def oracle_sql() -> dict[str, str]:
    """SQL of those it can express; the others are tested against brute force, round trips or held-out labels."""
    return {
        "op2_decontaminate": decontaminate.ORACLE,
        "op3_topk": topk.ORACLE,
        "op4_chat": chat.ORACLE,
        "op5_minhash": minhash.ORACLE,
        "op8_licenses": licenses.oracle(),
        "op9_suffix_dedup": suffix_dedup.ORACLE,
        "op11_negatives": negatives.ORACLE,
    }
