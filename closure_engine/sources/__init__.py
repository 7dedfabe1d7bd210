"""Edge sources (text edge lists, key columns of any table, the inline example)
and result sinks (``closure_engine.sources.sinks``)."""

from closure_engine.sources.columns import edges_from_columns, example_graph
from closure_engine.sources.tables import customer_supplier_edges, supply_edges, table
from closure_engine.sources.text import parse_edge_lines, read_edge_text, rejected_edge_lines

__all__ = [
    "customer_supplier_edges",
    "edges_from_columns",
    "example_graph",
    "parse_edge_lines",
    "read_edge_text",
    "rejected_edge_lines",
    "supply_edges",
    "table",
]
