"""Message passing over an edge table, as DataFrame joins and aggregates.

``aggregate_messages`` is one round: every edge may send a message to its
source and/or destination (Column expressions over the edge and the
``src_*`` / ``dst_*`` vertex attributes; a null message is not sent), and the
messages are merged per vertex by a built-in aggregate.  The merge runs as a
partial aggregate on the map side, so a hub receiving millions of messages
is summed inside each task before the shuffle.

``message_rounds`` chains a bounded number of rounds.  Every round adds a
join + aggregate to the plan, so with more than one round the edges are
checkpointed once and the vertex state every ``checkpoint_every`` rounds
(reliable ``checkpoint()`` in ``spark.checkpoint.dir``; eager, so building
the result runs jobs); a lost executor then recomputes from the last
checkpoint only.  ``checkpoint_every=0`` keeps everything lazy.  Each round
shuffles the edges to both ends, as a message may read both; rounds whose messages read
their sender only don't shuffle edges on a stored graph
(:mod:`closure_engine.operators.stored`), and messages that are sets are rows in
:mod:`closure_engine.operators.sets`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closure_engine.operators.adjacency import degree
from closure_engine.operators.graph import one_per_id, triplet_view
from closure_engine.operators.skew import hot_keys
from closure_engine.operators.triangles import SkewConfig
from closure_engine.session import ensure_checkpoint_dir

Merge = Callable[[Column], Column]


def aggregate_messages(edges: DataFrame, vertices: DataFrame | None, to_src: Column | None,
                       to_dst: Column | None, merge: Merge = F.sum, name: str = "msg",
                       src: str = "src", dst: str = "dst", id: str = "id",
                       count_name: str | None = None, hubs: DataFrame | None = None, unique: bool = False) -> DataFrame:
    """One round of messages: ``(id, <name>[, <count_name>])`` for vertices that got any.

    ``hubs`` (bounded ``id`` table) and ``unique`` (no id is repeated) are
    forwarded to :func:`triplet_view`.
    """
    view = edges if vertices is None else triplet_view(edges, vertices, src, dst, id, hubs=hubs, unique=unique)
    out = []
    if to_src is not None:
        out.append(F.struct(F.col(src).alias("id"), to_src.alias("msg")))
    if to_dst is not None:
        out.append(F.struct(F.col(dst).alias("id"), to_dst.alias("msg")))
    if not out:
        raise ValueError("send at least one of to_src / to_dst")
    msgs = (view.select(F.explode(F.array(*out)).alias("m"))
            .select(F.col("m.id").alias(id), F.col("m.msg").alias("msg"))
            .where(F.col("msg").isNotNull()))
    aggs = [merge(F.col("msg")).alias(name)]
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    return msgs.groupBy(id).agg(*aggs)


def message_rounds(edges: DataFrame, vertices: DataFrame | Callable[[DataFrame], DataFrame], state: str, rounds: int,
                   to_src: Column | None, to_dst: Column | None, merge: Merge = F.sum,
                   update: Callable[[Column, Column], Column] | None = None,
                   src: str = "src", dst: str = "dst", id: str = "id",
                   checkpoint_every: int = 1, skew: SkewConfig | None = None) -> DataFrame:
    """Run ``rounds`` rounds of messages; returns ``(id, <state>)`` for every vertex.

    ``vertices`` may be a function of the edges, which then sees the
    checkpointed ones.  Message expressions see ``src_<state>`` / ``dst_<state>``.  ``update(old,
    msg)`` gives the new state (default: the merged message, or the old
    state when a vertex got no message).
    """
    if rounds < 0:
        raise ValueError("rounds must be >= 0")
    if checkpoint_every and rounds > 1:
        ensure_checkpoint_dir(edges.sparkSession)  # the cluster's spark.checkpoint.dir if set
        edges = edges.checkpoint(eager=True)  # read once, not once a round
    cur = one_per_id(vertices(edges) if callable(vertices) else vertices, id).select(id, state)
    skew = skew or SkewConfig()
    hubs = hot_keys(degree(edges, src, dst), "id", "degree", skew.max_hot, skew.min_hot_rows).select("id")  # same edges every round
    for r in range(rounds):
        got = aggregate_messages(edges, cur, to_src, to_dst, merge, "_msg", src, dst, id, hubs=hubs, unique=True)
        j = cur.join(got, id, "left")
        old, msg = F.col(state), F.col("_msg")
        new = msg if update is None else update(old, msg)
        cur = j.select(id, F.when(msg.isNull(), old).otherwise(new).alias(state))
        if checkpoint_every and (r + 1) % checkpoint_every == 0 and r + 1 < rounds:
            cur = cur.checkpoint(eager=True)
    return cur
