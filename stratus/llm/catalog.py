"""The queries of the text operators and the DuckDB statements of those that SQL can express."""

from . import (alignment, chat, decontaminate, hard_negatives, licenses, line_dedup, packing, quality, quality_rules,
               secrets_scan, simhash, token_counts, toxicity)

QUERIES = {f.__name__: f for f in (
    quality_rules.op1_quality_rules, toxicity.op2_toxicity, chat.op3_chat_formatting, licenses.op4_license_scans,
    decontaminate.op5_benchmark_decontamination, secrets_scan.op6_secret_scans, token_counts.op7_token_counts,
    simhash.op8_simhash_near_dedup, packing.op9_best_fit_packing, quality.op10_quality_classifier,
    alignment.op11_cross_tokenizer_alignment, hard_negatives.op12_hard_negatives, line_dedup.op13_line_dedup)}

ORACLE = {"op1_quality_rules": quality_rules.OP1_SQL, "op3_chat_formatting": chat.OP3_SQL,
          "op12_hard_negatives": hard_negatives.OP12_SQL, "op13_line_dedup": line_dedup.OP13_SQL}
