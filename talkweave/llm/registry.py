"""All queries of this package and the SQL that checks them."""

from __future__ import annotations

from talkweave.llm import corpus_queries, document_queries, language_queries, meeting_queries, name_queries

_MODULES = [language_queries, name_queries, meeting_queries, corpus_queries, document_queries]

QUERIES: dict = {}
SQL: dict = {}
for _m in _MODULES:
    QUERIES |= _m.QUERIES
    SQL |= _m.SQL
