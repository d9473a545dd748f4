"""Operators for cleaning and packing large text corpora.

Nothing else in the library imports this subpackage.  Its registered queries
and their SQL are in :mod:`cohortkit.llm.queries`.
"""
