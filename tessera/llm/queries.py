"""Importing this module registers the queries of the training-data operators."""

from tessera.llm import (  # noqa: F401
    op1_fingerprints,
    op2_urls,
    op3_lattice,
    op4_packing,
    op5_language,
    op6_byte_bpe,
    op7_toxicity,
    op8_secrets,
    op9_pii,
    op10_bagminhash,
    op11_phrases,
    op12_alignment,
    op13_mixing,
)
from tessera.llm.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
