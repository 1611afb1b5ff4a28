"""All queries of the core and their SQL."""

from __future__ import annotations

from postmill.plans import collection, duplicates, marts, panels, quality, snapshots, texts
from postmill.streaming import ingest

MODULES = (snapshots, texts, duplicates, marts, panels, quality, collection, ingest)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
SQL = {k: s for m in MODULES for k, s in m.SQL.items()}
FLAGSHIP = "near_dup_groups"
