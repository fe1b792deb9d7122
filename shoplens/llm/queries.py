"""The registered queries of this package and, where SQL can express one, its DuckDB twin."""

from __future__ import annotations

from shoplens.llm import (decontaminate, exact_dedup, jaccard_join, line_dedup, merkle, mixing, ngram_lm, pii, resampling,
                          secrets, toxicity, vector_graph, warc)

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_ngram_lm": ngram_lm.op2_ngram_lm,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_pii_surrogates": pii.op4_pii_surrogates,
    "op5_secrets": secrets.op5_secrets,
    "op6_jaccard_join": jaccard_join.op6_jaccard_join,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_pareto_mix": mixing.op9_pareto_mix,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_vector_graph": vector_graph.op11_vector_graph,
    "op12_importance_resample": resampling.op12_importance_resample,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

SQL = {
    "op1_warc": warc.OP1_SQL,
    "op3_decontaminate": decontaminate.OP3_SQL,
    "op7_line_dedup": line_dedup.OP7_SQL,
    "op10_exact_dedup": exact_dedup.OP10_SQL,
    "op12_importance_resample": resampling.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
