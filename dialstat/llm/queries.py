"""Query names of the corpus operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from dialstat.llm import (decontaminate, filter_audit, html_main, license_scan, markov_scores, mixing, near_dedup,
                          periodic_runs, personal_data, quality_lm, quality_rules, suffix_dedup, url_filter)

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_mixing": mixing.query,
    "op3_html_main": html_main.query,
    "op4_markov_scores": markov_scores.query,
    "op5_personal_data": personal_data.query,
    "op6_near_dedup": near_dedup.query,
    "op7_quality_lm": quality_lm.query,
    "op8_decontaminate": decontaminate.query,
    "op9_url_filter": url_filter.query,
    "op10_license_scan": license_scan.query,
    "op11_suffix_dedup": suffix_dedup.query,
    "op12_filter_audit": filter_audit.query,
    "op13_periodic_runs": periodic_runs.query,
}

ORACLE = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op6_near_dedup": near_dedup.ORACLE,
    "op8_decontaminate": decontaminate.ORACLE,
    "op9_url_filter": url_filter.ORACLE,
    "op10_license_scan": license_scan.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
}
