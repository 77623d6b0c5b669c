"""Training-data operators: one module each, plus the queries that apply them.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
