"""Operators for preparing large text corpora.

Each module holds one operator; :mod:`fieldloom.llm.queries` registers the
digest queries.  Nothing outside this subpackage imports it.
"""
