"""One run of the graph service and of the learning service, for any scheduler."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtide.functions.times import AsOf, moment
from tagtide.operators import graph, learning
from tagtide.operators.communities import communities
from tagtide.schemas import KEYS
from tagtide.session import cut_lineage
from tagtide.sources.tables import replace_snapshot, upsert_snapshot, write_batch, write_run


def run_graph(
    posts: DataFrame, out: str, as_of: AsOf, time_window_hours: int = 24, sources: DataFrame | None = None
) -> bool:
    """Store centralities and communities below ``out``. False if there is no edge.

    ``sources`` are the pivots of an estimated betweenness; without them it is exact.
    """
    edges = cut_lineage(graph.cooccurrence_edges(posts, as_of, time_window_hours))
    if edges.isEmpty():
        return False
    upsert_snapshot(graph.centrality(edges, sources), f"{out}/hashtag_centrality", KEYS["hashtag_centrality"], as_of)
    found = communities(edges).withColumn("updated_at", moment(as_of))
    replace_snapshot(found, f"{out}/hashtag_communities")
    return True


def run_learning(posts: DataFrame, out: str, as_of: AsOf, unit: str = "hour", window: str = "24 hours") -> None:
    """Store user clusters, trend scores and anomalies below ``out``."""
    clusters = learning.cluster_users(posts, as_of)
    if not clusters.isEmpty():
        upsert_snapshot(clusters, f"{out}/user_clusters", KEYS["user_clusters"], as_of)
    write_run(learning.predict_trending(posts, as_of, unit, window), f"{out}/trending_predictions", as_of)
    # By day of detection, as retention deletes days. A run that is repeated replaces its own batch.
    run = posts.sparkSession.range(1).select(F.unix_seconds(moment(as_of).cast("timestamp"))).first()[0]
    write_batch(learning.detect_anomalies(posts, as_of), run, f"{out}/anomaly_detection", "detected_at")
