"""User clusters, trend scores and posting-rate anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.functions.numbers import abs_z, fill_zero, null_safe_div
from tagtide.functions.sentiment import reason_text
from tagtide.functions.times import AsOf
from tagtide.operators.metrics import hashtag_velocity, hourly_counts, recent_vs_history, score_bounds, user_features
from tagtide.operators.topk import velocity_top
from tagtide.session import cut_lineage
from tagtide.sources.tables import append_run

# The features users are clustered by, and the sizes of the job.
FEATURES = ("avg_sentiment", "avg_content_length", "post_count", "unique_hashtags")
MIN_USERS, USERS_PER_CLUSTER, MAX_CLUSTERS = 10, 10, 5
# Starts that are drawn for one that is followed, and rounds after which the others end.
DRAWN, SIFTING = 3, 3


def scale_features(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Each column less its mean, over its population deviation (1 if that is 0).

    The statistics are one row, read as a scalar subquery.
    """
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_dev") for c in columns],
        ).alias("stats")
    ).scalar()

    def scaled(c: str):
        dev = stats[f"{c}_dev"]
        return (F.col(c) - stats[f"{c}_mean"]) / F.when(dev == 0, F.lit(1.0)).otherwise(dev)

    return df.withColumns({c: scaled(c) for c in columns})


def _distances(point: Column, centres: Column) -> Column:
    """Squared distances of a point (an array) from an array of centres."""

    def to(centre: Column) -> Column:
        return F.aggregate(F.zip_with(point, centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)

    return F.transform(centres, to)


def _constant(centres: list[list[list[float]]]) -> Column:
    return F.array(*[F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in start]) for start in centres])


def first_centres(points: DataFrame, k: int, starts: int, seed: int) -> list[list[list[float]]]:
    """k-means++ for all starts at once: ``k`` passes over ``points`` (``key, p``), each of one aggregation.

    A start draws its next centre with probability in proportion to the squared distance from those
    it has: the least of -ln(u) / distance, with u from the point's key, so that reruns agree.
    """
    centres: list[list[list[float]]] = [[] for _ in range(starts)]
    for step in range(k):
        picks = []
        for r in range(starts):
            near = F.array_min(_distances(F.col("p"), _constant([centres[r]])[0])) if step else F.lit(1.0)
            drawn = (F.pmod(F.xxhash64(F.lit(seed), F.lit(r), F.lit(step), "key"), F.lit(1 << 40)) + 0.5) / (1 << 40)
            # Points on a centre come last; they count where nothing else is left.
            race = F.coalesce(F.try_divide(-F.ln(drawn), near), F.lit(float("inf")))
            picks.append(F.min_by("p", F.struct(race, "key")).alias(f"c{r}"))
        found = points.agg(*picks).first()
        for r in range(starts):
            centres[r].append(list(found[f"c{r}"]))
    return centres


def k_means(points: DataFrame, k: int, starts: int = 10, seed: int = 42, rounds: int = 300) -> tuple[list[list[float]], float]:
    """Centres and cost of the best of several starts over ``points`` (``key, p``).

    Every round is one aggregation for all starts: a point is assigned in each of them, and per
    start and centre the driver gets one row. More starts are drawn than are followed: after
    SIFTING rounds only the cheapest go on. A start rests once its centres do. A centre without
    points stays where it is.
    """
    centres = first_centres(points, k, DRAWN * starts, seed)
    cost, moving = [float("inf")] * len(centres), list(range(len(centres)))
    for done in range(rounds):
        if done == SIFTING:
            moving = sorted(sorted(moving, key=lambda r: cost[r])[:starts])
        each = points.select("p", F.posexplode(_constant([centres[r] for r in moving])).alias("r", "centres"))
        each = each.withColumn("d", _distances(F.col("p"), F.col("centres")))
        each = each.select("r", "p", F.array_min("d").alias("least"), (F.array_position("d", F.array_min("d")) - 1).alias("j"))
        size = len(centres[0][0])
        sums = each.groupBy("r", "j").agg(
            F.sum("least").alias("cost"), *[F.avg(F.col("p")[i]).alias(f"x{i}") for i in range(size)]
        )
        found = sums.collect()
        total, next_centres = dict.fromkeys(moving, 0.0), {r: [list(c) for c in centres[r]] for r in moving}
        for row in found:
            r = moving[row.r]
            total[r] += row.cost
            next_centres[r][row.j] = [row[f"x{i}"] for i in range(size)]
        still = []
        for r in moving:
            cost[r] = total[r]
            shift = max(abs(a - b) for old, new in zip(centres[r], next_centres[r]) for a, b in zip(old, new))
            if shift > 1e-9:
                centres[r] = next_centres[r]
                still.append(r)
        moving = still
        if not moving:
            break
    best = min(range(len(centres)), key=lambda r: cost[r])
    return centres[best], cost[best]


def cluster_users(posts: DataFrame, as_of: AsOf, seed: int = 42, restarts: int = 10) -> DataFrame:
    """k-means over scaled user features, the best of several starts, each at a fixed point.

    ``k = min(5, n div 10)``; below 10 users the result is empty, and one cluster needs
    no model.
    """
    features = cut_lineage(user_features(posts, as_of))
    n = features.count()
    k = min(MAX_CLUSTERS, n // USERS_PER_CLUSTER)
    columns = ("user_name", "cluster_id", *FEATURES)
    if k <= 1:
        only = features.withColumn("cluster_id", F.lit(0))
        return (only if n >= MIN_USERS else only.limit(0)).select(*columns)
    filled = fill_zero(features, list(FEATURES))
    scaled = scale_features(filled).select("user_name", *FEATURES)
    points = cut_lineage(scaled.select("user_name", F.xxhash64("user_name").alias("key"), F.array(*FEATURES).alias("p")))
    centres, _ = k_means(points.select("key", "p"), k, restarts, seed)
    d = _distances(F.col("p"), _constant([centres])[0])
    labels = points.withColumn("d", d).select(
        F.col("user_name").alias("_user"), (F.array_position("d", F.array_min("d")) - 1).cast("int").alias("cluster_id")
    )
    # Users may lack a name: such rows are one group of the features.
    joined = features.join(labels, F.col("user_name").eqNullSafe(F.col("_user")))
    return joined.select(*columns)


def predict_trending(
    posts: DataFrame, as_of: AsOf, unit: str = "hour", window: str = "24 hours"
) -> DataFrame:
    """Trend scores of the 50 fastest tags, scaled to 0..1; NULL if all are equal."""
    fastest = velocity_top(hashtag_velocity(hourly_counts(posts, as_of, window, unit)))
    raw = fastest.withColumn("prediction_score", F.col("velocity") * F.col("avg_count"))
    bounds = score_bounds(raw).select(F.struct("min_score", "max_score")).scalar()
    low, high = bounds["min_score"], bounds["max_score"]
    scores = raw.select(
        "hashtag",
        null_safe_div(F.col("prediction_score") - low, high - low).alias("prediction_score"),
        F.col("velocity").cast("double").alias("current_velocity"),
    )
    return append_run(scores, as_of, "predicted_at")


def detect_anomalies(posts: DataFrame, as_of: AsOf, threshold: float = 3.0) -> DataFrame:
    """Users whose last hour is far from their usual hours."""
    far = recent_vs_history(posts, as_of).filter(abs_z(F.col("z_score")) > threshold)
    found = far.select(
        "user_name",
        F.lit(None).cast("string").alias("hashtag"),
        abs_z(F.col("z_score")).alias("anomaly_score"),
        reason_text(F.col("recent_posts"), F.col("avg_posts_per_hour")).alias("reason"),
    )
    return append_run(found, as_of, "detected_at")
