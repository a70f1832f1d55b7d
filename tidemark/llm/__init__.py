"""Training-data operators: dedup, archives, quality, secrets, PII, vector and text search, mixing, tokenizing,
conversation repair and tries.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
