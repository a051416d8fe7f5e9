"""Name -> query and name -> oracle SQL of the library's own operators, over the driver's tables."""

from __future__ import annotations

from attesta.plans import agreement, files, funnel, lookups, nested, resolution, textual

QUERIES = textual.QUERIES | agreement.QUERIES | funnel.QUERIES | lookups.QUERIES | nested.QUERIES | files.QUERIES | resolution.QUERIES
ORACLE_SQL = textual.ORACLE_SQL | agreement.ORACLE_SQL | funnel.ORACLE_SQL | lookups.ORACLE_SQL | nested.ORACLE_SQL | files.ORACLE_SQL | resolution.ORACLE_SQL
