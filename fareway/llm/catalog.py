"""Registered queries of the corpus operators, and SQL where it can express them."""

from __future__ import annotations

from fareway.llm import (
    bpe, collocations, compress_quality, decontaminate, fill_middle, mixing, order_minhash, quality_rules, sharding,
    substring_dedup, topk, toxicity, warc,
)

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_bpe": bpe.query,
    "op3_toxicity": toxicity.query,
    "op4_compress_quality": compress_quality.query,
    "op5_warc": warc.query,
    "op6_substring_dedup": substring_dedup.query,
    "op7_mixing": mixing.query,
    "op8_order_minhash": order_minhash.query,
    "op9_feistel_sharding": sharding.query,
    "op10_topk": topk.query,
    "op11_fill_middle": fill_middle.query,
    "op12_decontaminate": decontaminate.query,
    "op13_collocations": collocations.query,
}

ORACLES: dict[str, str] = {
    "op1_quality_rules": quality_rules.oracle(),
    "op11_fill_middle": fill_middle.ORACLE,
    "op12_decontaminate": decontaminate.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
