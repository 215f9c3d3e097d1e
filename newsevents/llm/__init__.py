"""Operators of a training-data pipeline over a table of documents.

Every operator takes a DataFrame with an id column and a text column (other
columns are ignored, so clashing names do no harm) and returns a DataFrame.
``queries`` registers one query per operator; nothing outside this subpackage
imports it except ``__spark_entry__`` and ``corpus_pipeline``.
"""
