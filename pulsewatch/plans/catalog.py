"""All driver queries of the library and their SQL twins."""

from __future__ import annotations

from . import positions, registry, rollups, topics, upkeep

QUERIES: dict[str, registry.Query] = {**registry.QUERIES, **positions.QUERIES, **rollups.QUERIES, **topics.QUERIES,
                                       **upkeep.QUERIES}
SQL: dict[str, str] = {**registry.SQL, **positions.SQL, **rollups.SQL, **topics.SQL, **upkeep.SQL}
