"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this package; ``queries`` registers one
query per operator, and ``corpus_pipeline`` at the repository top chains five
of them.
"""
