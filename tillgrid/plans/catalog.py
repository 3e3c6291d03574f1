"""All registered queries and their oracle SQL, gathered from the plan modules."""

from __future__ import annotations

from tillgrid.plans import contract, roundtrips

QUERIES = {**contract.QUERIES, **roundtrips.QUERIES}
ORACLE_SQL = {**contract.ORACLE_SQL, **roundtrips.oracle_sql()}
