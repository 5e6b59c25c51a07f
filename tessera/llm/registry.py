"""The queries of this subpackage, and the SQL of those that SQL can express."""

from tessera.llm import (
    op1_mixing,
    op2_minhash,
    op3_warc,
    op4_sharding,
    op5_lines,
    op6_langid,
    op7_toxicity,
    op8_packing,
    op9_topk,
    op10_quality,
    op11_lexical,
    op12_collocations,
    op13_tokenids,
)

MODULES = [op1_mixing, op2_minhash, op3_warc, op4_sharding, op5_lines, op6_langid, op7_toxicity, op8_packing, op9_topk, op10_quality, op11_lexical, op12_collocations, op13_tokenids]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in MODULES for k, s in getattr(m, "SQL", {}).items()}
