"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from spanloom.llm import gif, linededup, mixing, packing, quality, simhash, substring, tokenbits, toxicity, warc


def queries() -> dict:
    import corpus_pipeline

    return {
        "pipeline": corpus_pipeline.run,
        "op1_substring_dedup": substring.op1_substring_dedup,
        "op2_mixing": mixing.op2_mixing,
        "op3_warc": warc.op3_warc,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_line_dedup": linededup.op5_line_dedup,
        "op6_gif_media": gif.op6_gif_media,
        "op7_token_bits": tokenbits.op7_token_bits,
        "op8_simhash_near_dedup": simhash.op8_simhash_near_dedup,
        "op9_packing": packing.op9_packing,
        "op10_quality_rules": quality.op10_quality_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": substring.ORACLE, "op3_warc": warc.ORACLE, "op5_line_dedup": linededup.ORACLE, "op10_quality_rules": quality.ORACLE}
