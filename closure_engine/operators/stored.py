"""A prepared graph on storage: cleaned, ranked and laid out once, used by every later measure and message round.

``store_graph`` writes, as one folder that is whole or absent,

* ``edges``: the canonical edges (u, v);
* ``degrees``: (id, degree);
* ``lists``: the rank-ordered out-lists (a, da, out) of the triangle step;
* ``hubs``: the vertices that may hold many edges, at most ``max_hot`` of them;
* ``by_u``, ``by_v``: the edges for message rounds, in as many files as the graph
  has buckets, hashed by the end that is named.

The measures take the handle instead of an edge table (``closure`` and all of
:mod:`triangles` and :mod:`measures`) and then neither clean, count degrees nor
orient again.  A later session opens the folder with ``open_graph``.

Message rounds on a handle never shuffle edges.  The two layouts are bucketed
tables: Spark joins a table that is bucketed by an end with the vertex states
dealt out by the same hash without moving its rows, so a round shuffles vertex
states and messages that are already merged per task.  An edge at a hub has no
key in the layout (its bucket is a hash of the edge, so hubs are spread) and
reads the hub's state from the broadcast hub table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closure_engine.operators.adjacency import degree
from closure_engine.operators.clean import canonical_edges
from closure_engine.operators.skew import hot_lookup
from closure_engine.operators.triangles import SkewConfig, _shuffle_width, hub_vertices, orient, out_lists
from closure_engine.session import ensure_checkpoint_dir
from closure_engine.sources.manifest import read_manifest, write_folder

_LAYOUT = "u bigint, v bigint, _key bigint, _side bigint"


@dataclass(frozen=True)
class StoredGraph:
    """Handle of a stored graph; its tables are read lazily."""

    spark: SparkSession
    path: str
    n_vertices: int
    n_edges: int
    buckets: int
    mark: str

    @property
    def canonical(self) -> DataFrame:
        return self.spark.read.schema("u bigint, v bigint").parquet(f"{self.path}/edges")

    @property
    def degrees(self) -> DataFrame:
        return self.spark.read.schema("id bigint, degree bigint").parquet(f"{self.path}/degrees")

    @property
    def lists(self) -> DataFrame:
        entry = "struct<d:bigint,id:bigint>"
        return self.spark.read.schema(f"a bigint, da bigint, out array<{entry}>").parquet(f"{self.path}/lists")

    @property
    def hubs(self) -> DataFrame:
        return self.spark.read.schema("id bigint, degree bigint").parquet(f"{self.path}/hubs")

    def _table(self, end: str) -> str:
        return f"closure_{end}_{self.mark}"

    def layout(self, end: str) -> DataFrame:
        """(u, v, _key, _side), bucketed by the end ``u`` or ``v``: declared over the written files in this session's catalog."""
        name = self._table(end)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_LAYOUT}) USING parquet CLUSTERED BY (_key, _side) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{self.path}/by_{end}'")
        return self.spark.table(name)

    def forget(self) -> None:
        """Takes the layouts out of the session's catalog; the files stay."""
        for end in ("u", "v"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(end)}")


def store_graph(edges: DataFrame, path: str, src: str = "src", dst: str = "dst", mode: str = "errorifexists",
                cfg: SkewConfig | None = None, buckets: int | None = None) -> StoredGraph:
    """Cleans and prepares a raw edge table once and keeps it under ``path``.

    ``buckets`` (default: the session's shuffle width) should suit the cluster,
    about an edge count of two files of 128 MB per core and wave; it is fixed for the folder.
    """
    spark, cfg = edges.sparkSession, cfg or SkewConfig()
    n = buckets or _shuffle_width(spark)

    def write(folder: str) -> dict:
        def kept(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{folder}/{name}")
            return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

        canon = kept(canonical_edges(edges, src, dst), "edges")
        deg = kept(degree(canon, "u", "v"), "degrees")
        hubs = kept(hub_vertices(deg, cfg), "hubs")
        kept(out_lists(orient(canon, deg, cfg, hubs), n), "lists")
        for end in ("u", "v"):
            hot = hubs.select(F.col("id").alias(end), F.lit(True).alias("_hot"))
            told = canon.join(F.broadcast(hot), end, "left")
            laid = told.select("u", "v", F.when(F.col("_hot").isNull(), F.col(end)).alias("_key"),
                               F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(F.xxhash64("u", "v")).cast("bigint").alias("_side"))
            made = f"closure_made_{uuid.uuid4().hex}"
            (laid.repartition(n, "_key", "_side").write.bucketBy(n, "_key", "_side")
             .option("path", f"{folder}/by_{end}").format("parquet").saveAsTable(made))
            spark.sql(f"DROP TABLE {made}")  # the files of a table with a path of its own stay
        counts = deg.agg(F.count("*").alias("n"), F.coalesce(F.sum("degree"), F.lit(0)).alias("d")).first()
        return {"kind": "graph", "n_vertices": counts["n"], "n_edges": counts["d"] // 2, "buckets": n, "mark": uuid.uuid4().hex}

    write_folder(spark, path, write, mode)
    return open_graph(spark, path)


def open_graph(spark: SparkSession, path: str) -> StoredGraph:
    """The handle of a stored graph, in this or a later session; an error if the folder is not whole."""
    path = path.rstrip("/")
    facts = read_manifest(spark, path)
    if facts.get("kind") != "graph":
        raise ValueError(f"{path} is no stored graph")
    return StoredGraph(spark, path, facts["n_vertices"], facts["n_edges"], facts["buckets"], facts["mark"])


def _resolves(df: DataFrame, expression: Column) -> bool:
    try:
        df.select(expression).schema
    except AnalysisException:
        return False
    return True


def _with_state(graph: StoredGraph, end: str, state: DataFrame, hot: DataFrame, columns: list[str]) -> DataFrame:
    """The layout by ``end`` with that end's state as ``<end>_<column>``; the edges stay in their buckets."""
    values = lambda mark: [F.col(c).alias(f"{mark}{c}") for c in columns]
    probed = graph.layout(end).join(F.broadcast(hot.select(F.col("id").alias(end), F.lit(True).alias("_hot"), *values("_hot_"))), end, "left")
    # _side is 0 for every state; not a constant, which the planner would take out of the join's keys and the buckets with it
    cold = state.select(F.col("id").alias("_key"), (F.col("id") - F.col("id")).alias("_side"), *values("_cold_"))
    cold = cold.repartition(graph.buckets, "_key", "_side")
    # a bucket's states are a row a vertex and are hashed; the edges are not sorted
    joined = probed.join(cold.hint("shuffle_hash"), ["_key", "_side"], "left")
    pick = [F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}")).alias(f"{end}_{c}") for c in columns]
    return joined.select("u", "v", *pick)


def stored_messages(graph: StoredGraph, vertices: DataFrame, to_u: Column | None, to_v: Column | None,
                    merge: Callable[[Column], Column] = F.sum, name: str = "msg") -> DataFrame:
    """One round on a stored graph: ``(id, <name>)`` for vertices that got a message.

    ``vertices``: ``id`` and state columns of bounded width, one row an id.  A
    message may read the edge and the state of its sender (``to_v``: ``u_<column>``;
    ``to_u``: ``v_<column>``) and nothing of its receiver: that is what lets edges
    stay where they are.  For the others use :func:`aggregate_messages` on
    ``graph.canonical``.
    """
    columns = [c for c in vertices.columns if c != "id"]
    hot = hot_lookup(vertices, "id", graph.hubs)
    sent = []
    for receiver, sender, message in (("u", "v", to_u), ("v", "u", to_v)):
        if message is not None:
            view = _with_state(graph, sender, vertices, hot, columns)
            if not _resolves(view, message):
                raise ValueError(f"a message to {receiver} may read the edge and {sender}_<column> only")
            sent.append(view.select(F.col(receiver).alias("id"), message.alias("msg")).where(F.col("msg").isNotNull()))
    if not sent:
        raise ValueError("send at least one of to_u / to_v")
    both = sent[0] if len(sent) == 1 else sent[0].unionByName(sent[1])
    return both.groupBy("id").agg(merge(F.col("msg")).alias(name))


def stored_rounds(graph: StoredGraph, vertices: DataFrame, state: str, rounds: int, to_u: Column | None, to_v: Column | None,
                  merge: Callable[[Column], Column] = F.sum, update: Callable[[Column, Column], Column] | None = None,
                  checkpoint_every: int = 1) -> DataFrame:
    """``rounds`` rounds of :func:`stored_messages`; returns ``(id, <state>)`` for every vertex.

    ``update(old, msg)`` gives the new state (default: the merged message, or
    the old state where no message came).  The state is checkpointed every
    ``checkpoint_every`` rounds.
    """
    if rounds < 0:
        raise ValueError("rounds must be >= 0")
    ensure_checkpoint_dir(graph.spark)
    cur = vertices.select("id", state)
    for r in range(rounds):
        got = stored_messages(graph, cur, to_u, to_v, merge, "_msg")
        old, msg = F.col(state), F.col("_msg")
        new = msg if update is None else update(old, msg)
        cur = cur.join(got, "id", "left").select("id", F.when(msg.isNull(), old).otherwise(new).alias(state))
        if checkpoint_every and (r + 1) % checkpoint_every == 0 and r + 1 < rounds:
            cur = cur.checkpoint(eager=True)
    return cur
