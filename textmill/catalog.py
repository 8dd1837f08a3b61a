"""Names of all registered queries, and the SQL that gives the same rows."""

from __future__ import annotations

from .plans import crawl, documents, metadata  # noqa: F401 - they register their queries
from .registry import ORACLE_SQL, QUERIES

FLAGSHIP = "qlt_document_metrics"
__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
