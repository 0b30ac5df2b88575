"""Named queries over the test tables and the SQL that gives the same rows."""

from __future__ import annotations

from creditloom.queries import customers, loans, relations, stores

MODULES = (loans, customers, stores, relations)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
