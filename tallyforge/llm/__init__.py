"""Operators for large training-data pipelines; nothing else in the library imports them."""

from tallyforge.llm import chat_format, crf_language, decontaminate, html_extract, lattice_lm, ngram_join, packing, periodic_runs, phrases, spotsigs, token_counts, url_filter, warc

MODULES = (chat_format, crf_language, decontaminate, html_extract, lattice_lm, ngram_join, packing, periodic_runs, phrases, spotsigs, token_counts, url_filter, warc)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
