"""Queries of this subpackage, by name, with SQL where SQL can express them."""

from __future__ import annotations

from newsloom.llm import decontam, licences, lines, mixture, packing, pii, prefixtrie, quality, setjoin, toxicity, urlrules, vectorcodes, warc

QUERIES = {
    "op1_url_filter": urlrules.op1_url_filter,
    "op2_licence_scan": licences.op2_licence_scan,
    "op3_benchmark_decontamination": decontam.op3_benchmark_decontamination,
    "op4_personal_data": pii.op4_personal_data,
    "op5_warc": warc.op5_warc,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_line_dedup": lines.op7_line_dedup,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_ngram_jaccard_join": setjoin.op9_ngram_jaccard_join,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_vector_codes": vectorcodes.op11_vector_codes,
    "op12_prefix_trie": prefixtrie.op12_prefix_trie,
    "op13_source_mixing": mixture.op13_source_mixing,
}

SQL = {
    "op1_url_filter": urlrules.OP1_SQL,
    "op5_warc": warc.OP5_SQL,
    "op7_line_dedup": lines.OP7_SQL,
    "op11_vector_codes": vectorcodes.OP11_SQL,
    "op12_prefix_trie": prefixtrie.OP12_SQL,
}
