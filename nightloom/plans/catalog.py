"""The named queries over the driver's tables, and for each the SQL that gives the same rows."""

from __future__ import annotations

from . import frame_queries, ingest_queries, more_queries, quality_checks, quality_queries, selections, spectrum_queries, spectrum_queries_2, stat_queries, stream_queries, time_joins

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _part in (time_joins, selections, stat_queries, spectrum_queries, stream_queries, quality_queries, more_queries, spectrum_queries_2, quality_checks, ingest_queries, frame_queries):
    QUERIES |= _part.Q.queries
    ORACLE_SQL |= _part.Q.oracles
