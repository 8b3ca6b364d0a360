"""Operators of a training-data pipeline over text."""

from __future__ import annotations


def queries() -> dict:
    from . import bigru, bloom_lm, decontamination, gbt_quality, packing, quality_rules, sharding, simhash, token_counts, url_filter

    return {
        "op1_language_id": bigru.op1_language_id,
        "op2_token_counts": token_counts.op2_token_counts,
        "op3_simhash": simhash.op3_simhash,
        "op4_packing": packing.op4_packing,
        "op5_quality": gbt_quality.op5_quality,
        "op6_sharding": sharding.op6_sharding,
        "op7_decontamination": decontamination.op7_decontamination,
        "op8_url_filter": url_filter.op8_url_filter,
        "op9_quality_rules": quality_rules.op9_quality_rules,
        "op10_bloom_lm": bloom_lm.op10_bloom_lm,
    }


def oracle_sql() -> dict[str, str]:
    from . import decontamination, quality_rules

    return {"op7_decontamination": decontamination.ORACLE_SQL, "op9_quality_rules": quality_rules.ORACLE_SQL}
