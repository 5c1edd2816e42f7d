"""Operators for building training data. Nothing outside this folder and corpus_pipeline.py imports it."""
