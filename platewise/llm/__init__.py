"""Operators for large training-data corpora (documents, embeddings, conversations).

Each module holds one operator with its own general interface; ``queries.py``
registers one thin query per operator.  Nothing outside this subpackage and
``corpus_pipeline.py`` imports it.
"""
