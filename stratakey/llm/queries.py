"""The numbered queries and their SQL."""

from __future__ import annotations

from . import ball_kmeans, decontaminate, html_extract, jaccard_join, license_scan, line_dedup, merkle, mixing, pii, quality_classifier, quality_rules, sharding, url_filter

QUERIES = {
    "op1_pii_surrogates": pii.op1_pii_surrogates,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_sharding": sharding.op3_sharding,
    "op4_quality_classifier": quality_classifier.op4_quality_classifier,
    "op5_source_mixing": mixing.op5_source_mixing,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_html_extraction": html_extract.op10_html_extraction,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_license_scan": license_scan.op12_license_scan,
    "op13_ball_kmeans": ball_kmeans.op13_ball_kmeans,
}
SQL = {
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op5_source_mixing": mixing.OP5_SQL,
    "op7_quality_rules": quality_rules.OP7_SQL,
    "op8_decontamination": decontaminate.OP8_SQL,
    "op9_jaccard_join": jaccard_join.OP9_SQL,
    "op11_merkle_manifest": merkle.OP11_SQL,
    "op13_ball_kmeans": ball_kmeans.OP13_SQL,
}
