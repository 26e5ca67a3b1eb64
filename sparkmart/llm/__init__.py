"""Operators of a training-data pipeline: one module per operator, each with
a general interface of its own; ``queries`` holds the thin registered queries.
Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it."""
