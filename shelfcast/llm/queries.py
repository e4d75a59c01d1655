"""Registered queries of the subpackage: name -> f(spark, sf_dir), and their SQL."""

from __future__ import annotations

from shelfcast.llm import (
    decontaminate,
    edit_fingerprint,
    katz,
    manifest,
    near_dedup,
    packing,
    repeats,
    resampling,
    secrets,
    sharding,
    site_quality,
    toxicity,
    warc,
)

REGISTRY = {
    "op1_warc_derivatives": warc.op1_warc_derivatives,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_site_quality": site_quality.op3_site_quality,
    "op4_edit_fingerprint": edit_fingerprint.op4_edit_fingerprint,
    "op4_edit_components": edit_fingerprint.op4_edit_components,
    "op5_repeats": repeats.op5_repeats,
    "op6_packing": packing.op6_packing,
    "op7_sharding": sharding.op7_sharding,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_merkle_manifest": manifest.op11_merkle_manifest,
    "op12_importance_resampling": resampling.op12_importance_resampling,
    "op13_katz_scores": katz.op13_katz_scores,
}

ORACLES = {
    "op1_warc_derivatives": warc.op1_sql(),
    "op3_site_quality": site_quality.op3_sql(),
    "op7_sharding": sharding.op7_sql(),
    "op11_merkle_manifest": manifest.op11_sql(),
    "op12_importance_resampling": resampling.op12_sql(),
}
