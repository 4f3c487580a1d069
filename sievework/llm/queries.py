"""The registered queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from . import decontamination, html_extraction, periodic_runs, phrase_mining, quality_classifier, quality_rules, secret_scan, simhash_dedup, source_mixing, suffix_dedup, token_files, toxicity, warc_derivatives

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_token_files": token_files.op2_token_files,
    "op3_benchmark_decontamination": decontamination.op3_benchmark_decontamination,
    "op4_simhash_near_dedup": simhash_dedup.op4_simhash_near_dedup,
    "op5_quality_classifier": quality_classifier.op5_quality_classifier,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_warc_derivatives": warc_derivatives.op7_warc_derivatives,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_source_mixing": source_mixing.op10_source_mixing,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_main_text": html_extraction.op12_main_text,
    "op13_phrase_collocations": phrase_mining.op13_phrase_collocations,
}

ORACLE_SQL = {
    "op1_secret_scan": secret_scan.OP1_SQL,
    "op6_quality_rules": quality_rules.OP6_SQL,
    "op7_warc_derivatives": warc_derivatives.OP7_SQL,
    "op10_source_mixing": source_mixing.OP10_SQL,
    "op13_phrase_collocations": phrase_mining.OP13_SQL,
}
