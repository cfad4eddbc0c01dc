"""All queries of the core, with the SQL of those that SQL can express."""

from __future__ import annotations

from tidewright.plans import bronze, canonical, claims, control, marts, problems, reference  # noqa: F401 (all register their queries)


def queries() -> dict:
    return {**problems.QUERIES, **reference.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**problems.SQL, **reference.SQL}
