"""All queries of the library by name, and the SQL that says the same."""

from __future__ import annotations

from leafmill.plans import corpus, evidence, more, orders, quotas, texts, vectors

_PARTS = (quotas, orders, corpus, vectors, evidence, texts, more)
QUERIES: dict = {k: v for part in _PARTS for k, v in part.QUERIES.items()}
#: A query without SQL (None) is tested against a brute-force version.
ORACLE_SQL: dict = {k: v for part in _PARTS for k, v in part.SQL.items() if v}
