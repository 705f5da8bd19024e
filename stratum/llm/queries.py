"""The operators of this package as queries over the driver's tables, with SQL where SQL can express them."""

from __future__ import annotations

from stratum.llm import ann, divergence, exact, infill, langid, mixing, packing, pii, quality, simhash, suffix, tokencount, warc

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_personal_data": pii.op2_personal_data,
    "op3_nearest_neighbours": ann.op3_nearest_neighbours,
    "op4_language_id": langid.op4_language_id,
    "op5_repeated_passages": suffix.op5_repeated_passages,
    "op6_exact_dedup": exact.op6_exact_dedup,
    "op7_warc_round_trip": warc.op7_warc_round_trip,
    "op8_simhash_near_duplicates": simhash.op8_simhash_near_duplicates,
    "op9_pack_sequences": packing.op9_pack_sequences,
    "op10_token_counts": tokencount.op10_token_counts,
    "op11_quality_classifier": quality.op11_quality_classifier,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_fill_in_middle": infill.op13_fill_in_middle,
}
ORACLES = {
    "op1_mix_sources": mixing.ORACLE,
    "op6_exact_dedup": exact.ORACLE,
    "op7_warc_round_trip": warc.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
    "op13_fill_in_middle": infill.ORACLE,
}
