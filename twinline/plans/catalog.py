"""All registered queries of the engine and their oracle SQL."""

from __future__ import annotations

from . import records, relational

QUERIES = {**relational.QUERIES, **records.QUERIES}
SQL = {**relational.SQL, **records.SQL}
