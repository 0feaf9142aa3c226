"""All queries over the catalog and corpus operators, with their SQL oracles."""

from __future__ import annotations

from quillmill.plans import catalogs, corpora, ledgers, screening  # noqa: F401  they register their queries
from quillmill.plans.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
