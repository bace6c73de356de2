"""Operators of a training-data pipeline over a ``documents`` table.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
