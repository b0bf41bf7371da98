"""Operators for preparing large text corpora (training data): archives, extraction,
language, quality, near duplicates, nearest neighbours, tokens, packing, sharding.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
