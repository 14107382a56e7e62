"""The two services, the views, and the options of connectors."""

import pytest

from tagtide.operators.metrics import trending_aspects
from tagtide.plans.jobs import run_graph, run_learning
from tagtide.plans.views import register_views
from tagtide.sources import fixtures, messages
from tagtide.sources.tables import read_snapshot

AS_OF = fixtures.AS_OF


def test_graph_service(spark, sf, tmp_path):
    out = str(tmp_path)
    posts = fixtures.posts(spark, sf)
    assert run_graph(posts, out, AS_OF)
    stored = read_snapshot(spark, f"{out}/hashtag_centrality")
    assert stored.columns == ["hashtag", "degree_centrality", "betweenness_centrality", "pagerank", "updated_at"]
    found = read_snapshot(spark, f"{out}/hashtag_communities")
    assert found.count() == stored.count() == 37
    assert not run_graph(posts, out, "2024-03-01 00:00:00")


def test_learning_service(spark, sf, tmp_path):
    out = str(tmp_path)
    posts = fixtures.posts(spark, sf)
    for as_of in ("2024-01-30 00:00:00", AS_OF, AS_OF):
        run_learning(posts, out, as_of, "day", "7 days")
    runs = spark.read.parquet(f"{out}/trending_predictions").groupBy("predicted_at").count().collect()
    assert len(runs) == 2 and all(r["count"] <= 50 for r in runs)
    assert read_snapshot(spark, f"{out}/user_clusters").select("cluster_id").distinct().count() == 1
    assert "reason" in spark.read.parquet(f"{out}/anomaly_detection").columns


def test_views(spark, sf):
    posts, aspects = fixtures.posts(spark, sf), fixtures.aspects(spark, sf)
    names = register_views(posts, aspects, AS_OF)
    for name in names:
        assert spark.sql(f"SELECT * FROM {name}").count() >= 0
    assert spark.table("trending_aspects").columns == trending_aspects(aspects, AS_OF).columns
    assert spark.sql("SELECT max(total_posts) FROM hashtag_stats").first()[0] > 100


def test_kafka_options(spark):
    options = messages.kafka_options("host:1", "raw", maxOffsetsPerTrigger="5")
    assert options == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "raw", "startingOffsets": "latest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5",
    }
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.read_raw(spark, **options)
