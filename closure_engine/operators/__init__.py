"""Graph operators over DataFrames: cleaning, views, degrees, triangles, measures, messages."""

from closure_engine.operators.adjacency import degree, half_edges, neighbour_list, neighbour_set
from closure_engine.operators.clean import canonical_edges, drop_exact_duplicates, drop_loops
from closure_engine.operators.graph import (
    endpoints,
    join_vertices,
    one_per_id,
    repeated_ids,
    triplet_view,
    vertices_from_edges,
    with_vertices,
)
from closure_engine.operators.measures import (
    Closure,
    average_closure,
    closure,
    local_closure,
    summarize,
    transitivity,
    triplets_per_vertex,
    triplets_total,
)
from closure_engine.operators.messages import aggregate_messages, message_rounds
from closure_engine.operators.sets import common_element_sums, intersect_sets, neighbour_sets, send_sets
from closure_engine.operators.stored import StoredGraph, open_graph, store_graph, stored_messages, stored_rounds
from closure_engine.operators.triangles import (
    SkewConfig,
    block_meetings,
    hub_vertices,
    closing,
    closing_with_multiplicity,
    common_neighbour_counts,
    common_neighbour_sums,
    common_neighbours,
    orient,
    triangle_counts,
    triangle_list,
    triangles_by_intersect,
    triangles_per_vertex,
    triangles_total,
)

__all__ = [
    "Closure", "SkewConfig", "StoredGraph", "block_meetings", "closing_with_multiplicity", "common_element_sums",
    "intersect_sets", "neighbour_sets", "one_per_id", "open_graph", "repeated_ids", "send_sets", "store_graph", "stored_messages", "stored_rounds", "aggregate_messages", "hub_vertices", "average_closure", "canonical_edges", "closing", "closure",
    "common_neighbour_counts", "common_neighbour_sums", "common_neighbours", "degree",
    "drop_exact_duplicates", "drop_loops", "endpoints", "half_edges", "join_vertices",
    "local_closure", "message_rounds", "neighbour_list", "neighbour_set", "orient", "summarize",
    "transitivity", "triangle_counts", "triangle_list", "triangles_by_intersect",
    "triangles_per_vertex", "triangles_total", "triplet_view", "triplets_per_vertex",
    "triplets_total", "vertices_from_edges", "with_vertices",
]
