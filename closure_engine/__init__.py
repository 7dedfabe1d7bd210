"""closure_engine: clustering coefficients (local, global, average) as Spark DataFrames.

Typical use::

    from closure_engine import closure, read_edge_text
    result = closure(read_edge_text(spark, "edges.txt"))
    result.per_vertex   # id, degree, triangles, triplets, local
    result.summary      # n_vertices, n_edges, triangles, triplets, transitivity, average
"""

from closure_engine.operators import *  # noqa: F401,F403
from closure_engine.operators import __all__ as _ops_all
from closure_engine.sources import (
    customer_supplier_edges,
    edges_from_columns,
    example_graph,
    parse_edge_lines,
    read_edge_text,
    supply_edges,
)

from closure_engine.plans.programs import closure_from_text, global_coefficient
from closure_engine.sources.sinks import read_closure, write_closure

__all__ = list(_ops_all) + [
    "closure_from_text", "global_coefficient", "read_closure", "write_closure",
    "customer_supplier_edges", "edges_from_columns", "example_graph", "parse_edge_lines",
    "read_edge_text", "supply_edges",
]
