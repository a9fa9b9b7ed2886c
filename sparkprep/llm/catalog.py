"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from sparkprep.llm import exact_dedup, jaccard_join, language, line_dedup, phrase_index, quality, sentencepiece_nbest, site_style, spelling_variants, token_counts, tokenizer_alignment, url_filter, warc

_QUERIES = {
    "op1_html_extraction": (site_style.op1_html_extraction, None),
    "op2_sentencepiece": (sentencepiece_nbest.op2_sentencepiece, None),
    "op3_decontamination": (phrase_index.op3_decontamination, phrase_index.OP3_SQL),
    "op5_warc": (warc.op5_warc, warc.OP5_SQL),
    "op4_quality_classifier": (quality.op4_quality_classifier, None),
    "op6_language_id": (language.op6_language_id, None),
    "op7_line_dedup": (line_dedup.op7_line_dedup, line_dedup.OP7_SQL),
    "op8_ngram_jaccard": (jaccard_join.op8_ngram_jaccard, jaccard_join.OP8_SQL),
    "op9_exact_dedup": (exact_dedup.op9_exact_dedup, exact_dedup.OP9_SQL),
    "op10_url_filters": (url_filter.op10_url_filters, url_filter.OP10_SQL),
    "op11_spelling_variants": (spelling_variants.op11_spelling_variants, spelling_variants.OP11_SQL),
    "op12_token_counts": (token_counts.op12_token_counts, None),
    "op13_tokenizer_alignment": (tokenizer_alignment.op13_tokenizer_alignment, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}


def queries():
    return {name: fn for name, (fn, _) in _QUERIES.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql is not None}
