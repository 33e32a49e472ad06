"""Operators of a training-data pipeline: one module per operator.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
