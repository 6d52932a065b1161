"""Queries over the reference tables, each an operator of the library, and the SQL that says the same.

Modules register (name, function, SQL) in ``CATALOGUES``; SQL is None where it cannot express the operator.
"""

from __future__ import annotations

from .query_sets import cases_and_signals, curation, loading, policy, retrieval, searching, storing, texts

CATALOGUES = (cases_and_signals, policy, retrieval, searching, texts, curation, storing, loading)
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _set in CATALOGUES:
    for _name, _query, _sql in _set.REGISTER:
        QUERIES[_name] = _query
        if _sql is not None:
            ORACLE_SQL[_name] = _sql
