"""Operators for preparing language-model training data.

Each module is one operator over a table of texts, pages or vectors. Nothing
outside this folder and ``corpus_pipeline.py`` imports it.
"""
