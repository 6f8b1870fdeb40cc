"""Operators of a training-data pipeline: mixing, chat formatting, token output,
WARC, sharding, quality rules, decontamination, language-model scoring,
toxicity and n-gram similarity joins.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
