"""Operators and queries of a training-data pipeline over text corpora.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
