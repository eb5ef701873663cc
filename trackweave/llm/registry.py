"""Queries of the operators for training-data pipelines, and their SQL where SQL can express them."""

from __future__ import annotations

from . import decontaminate, html_text, licenses, mixing, near_dedup, quality_model, quality_rules, substring_dedup, token_counts, url_filter

_QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_mixing": mixing.op2_mixing,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_quality_classifier": quality_model.op4_quality_classifier,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_html_extraction": html_text.op6_html_extraction,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_near_dedup": near_dedup.op9_near_dedup,
    "op10_url_filter": url_filter.op10_url_filter,
}
_ORACLES = {
    "op1_license_scan": licenses.ORACLE,
    "op5_decontamination": decontaminate.ORACLE,
    "op7_quality_rules": quality_rules.ORACLE,
    "op10_url_filter": url_filter.ORACLE,
}


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
