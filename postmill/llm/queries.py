"""Registry of the subpackage's queries."""

from __future__ import annotations

from postmill.llm import corpus_queries, dedup_queries, language_queries, mapping_queries, pii_queries, spam_queries

MODULES = (dedup_queries, pii_queries, mapping_queries, language_queries, corpus_queries, spam_queries)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
SQL = {k: s for m in MODULES for k, s in m.SQL.items()}
