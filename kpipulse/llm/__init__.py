"""Operators for large training-data pipelines (text corpora and chats).

Nothing else in the library imports this package. ``queries`` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five
of them.
"""
