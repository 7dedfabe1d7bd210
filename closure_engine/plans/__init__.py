"""Query plans over the driver tables: named graphs, registered queries, SQL oracles."""

from closure_engine.plans.graphs import RAW_SQL, raw_edges, sql_prefix
from closure_engine.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "RAW_SQL", "raw_edges", "sql_prefix"]
