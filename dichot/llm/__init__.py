"""Operators of a training-data pipeline: filtering, deduplication,
decontamination, counting and packing of text corpora.

Each module holds one operator with its own general interface;
:mod:`dichot.llm.queries` registers one query per operator.  Nothing outside
this package imports it.
"""
