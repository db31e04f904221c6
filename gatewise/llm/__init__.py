"""Training-data operators: sharding, de-duplication, tokens, mixing, scoring.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
