"""The registered queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from tidegauge.llm import (
    collocations,
    decontaminate,
    divergence,
    language_id,
    license_scan,
    line_dedup,
    minhash_dedup,
    mixing,
    ngram_join,
    quality_rules,
    suffix_dedup,
    token_counts,
    warc,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_mixing": mixing.op4_mixing,
    "op5_warc": warc.op5_warc,
    "op6_ngram_join": ngram_join.op6_ngram_join,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_license_scan": license_scan.op9_license_scan,
    "op10_language_id": language_id.op10_language_id,
    "op11_divergence": divergence.op11_divergence,
    "op12_collocations": collocations.op12_collocations,
    "op13_minhash_dedup": minhash_dedup.op13_minhash_dedup,
}

SQL = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op3_decontaminate": decontaminate.OP3_SQL,
    "op4_mixing": mixing.OP4_SQL,
    "op7_quality_rules": quality_rules.OP7_SQL,
    "op9_license_scan": license_scan.OP9_SQL,
    "op11_divergence": divergence.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
}
