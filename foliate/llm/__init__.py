"""Operators for preparing training data, each usable on its own.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
