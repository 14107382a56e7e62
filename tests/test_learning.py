"""Clusters, trends and anomalies."""

import pytest
from pyspark.sql import functions as F

from tagtide.operators import learning, metrics
from tagtide.sources import fixtures

AS_OF = "2024-01-31 00:00:00"


def users(spark, n, posts=6):
    return spark.range(n * posts).select(
        F.concat(F.lit("u"), (F.col("id") % n).cast("string")).alias("user_name"),
        F.concat(F.lit("t"), (F.col("id") % 5).cast("string")).alias("hashtag"),
        ((F.col("id") % n) / n).alias("sentiment"),
        F.lit(10.0).alias("content_length"),
        F.lit("2024-01-30 12:00:00").cast("timestamp_ntz").alias("processing_time"),
    )


def counts(spark, per_hour):
    rows = [(f"2024-01-30 {10 + h}:00:00", "t") for h, n in enumerate(per_hour) for _ in range(n)]
    df = spark.createDataFrame(rows, "processing_time string, hashtag string")
    return df.withColumn("processing_time", F.col("processing_time").cast("timestamp_ntz"))


@pytest.mark.parametrize("n, clusters", [(9, 0), (15, 1)])
def test_few_users(spark, n, clusters):
    found = learning.cluster_users(users(spark, n), AS_OF)
    assert found.count() == (n if clusters else 0)
    assert found.select("cluster_id").distinct().count() == clusters


def test_clusters_of_the_fixture(spark):
    posts = fixtures.posts(spark, "/root/testdata/sf0.01")
    found = learning.cluster_users(posts, AS_OF, restarts=2).collect()
    assert len(found) == metrics.user_features(posts, AS_OF).count()
    assert {r.cluster_id for r in found} == set(range(5))


def test_no_worse_than_the_best_of_ten_single_fits(spark, sf):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    scaled = learning.scale_features(metrics.user_features(fixtures.posts(spark, sf), AS_OF, 2))
    points = scaled.select(F.xxhash64("user_name").alias("key"), F.array(*learning.FEATURES).alias("p"))
    centres, cost = learning.k_means(points, 4, 10)
    vectors = points.select(array_to_vector("p").alias("features"))
    assert cost <= min(KMeans(k=4, seed=i).fit(vectors).summary.trainingCost for i in range(10)) * (1 + 1e-9)
    # A fixed point: every centre is the mean of the points that are nearest to it.
    rows = [r.p for r in points.collect()]
    near = [min(range(4), key=lambda j: sum((a - b) ** 2 for a, b in zip(p, centres[j]))) for p in rows]
    for j, centre in enumerate(centres):
        own = [p for p, n in zip(rows, near) if n == j]
        assert centre == pytest.approx([sum(x) / len(own) for x in zip(*own)], abs=1e-6)


def test_all_starts_share_a_job_per_round(spark):
    rows = spark.range(200).selectExpr("id AS key", "array(id % 7 * 1.0D, id % 3 * 1.0D) AS p")
    spark.sparkContext.setJobGroup("rounds", "")
    try:
        learning.k_means(rows, 3, starts=8, rounds=2)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("rounds"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Three passes to begin with and two rounds, of one aggregation each.
    assert jobs <= 2 * (3 + 2)


def test_fewer_distinct_points_than_centres(spark):
    rows = spark.createDataFrame([(i, [float(i % 2)]) for i in range(20)], "key long, p array<double>")
    centres, cost = learning.k_means(rows, 3, 2)
    assert cost == 0.0 and {c[0] for c in centres} == {0.0, 1.0}


def test_constant_feature_is_not_scaled(spark):
    scaled = learning.scale_features(spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double"), ["a", "b"])
    assert sorted(tuple(r) for r in scaled.collect()) == [(-1.0, 0.0), (1.0, 0.0)]


@pytest.mark.parametrize("per_hour, velocity", [([1, 4, 3], 1), ([1, 2, 1], 0), ([3, 4], None)])
def test_velocity(spark, per_hour, velocity):
    found = metrics.hashtag_velocity(metrics.hourly_counts(counts(spark, per_hour), AS_OF)).collect()
    assert [r.velocity for r in found] == ([] if velocity is None else [velocity])
    if velocity:
        assert found[0].avg_count == pytest.approx(8 / 3)


def test_equal_velocities_have_no_score(spark):
    rows = counts(spark, [1, 2, 1])
    both = rows.unionByName(rows.withColumn("hashtag", F.lit("s")))
    assert [r.prediction_score for r in learning.predict_trending(both, AS_OF).collect()] == [None, None]
