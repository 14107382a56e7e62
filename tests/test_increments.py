"""Statistics that are kept up to date day by day, against a full computation."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tagtide.operators import increments, metrics
from tagtide.operators.increments import ASPECTS, HASHTAGS, refresh
from tagtide.sources import fixtures, tables


def plain(df):
    rows = [[r[c] for c in sorted(df.columns)] for r in df.collect()]
    rows.sort(key=lambda row: str([x for x in row if not isinstance(x, float)]))
    return [[pytest.approx(x, rel=1e-9, abs=1e-12) if isinstance(x, float) else x for x in row] for row in rows]


def values(df):
    return [[getattr(x, "expected", x) for x in row] for row in plain(df)]


@pytest.fixture(scope="module")
def posts(spark, sf):
    rows = fixtures.posts(spark, sf)
    # Users, tags, scores and times may be missing.
    return rows.withColumns(
        {
            "user_name": F.when(F.col("post_id") % 7 > 0, F.col("user_name")),
            "sentiment": F.when(F.col("post_id") % 5 > 0, F.col("sentiment")),
            "processing_time": F.when(F.col("post_id") % 11 > 0, F.col("processing_time")),
            "hashtag": F.when(F.col("post_id") % 13 > 0, F.col("hashtag")),
        }
    )


def test_new_days_and_grown_days(posts, tmp_path):
    path = str(tmp_path)
    steps = ["processing_time < '2024-01-10'", "processing_time < '2024-01-10 12:00:00' OR processing_time IS NULL", "true"]
    seen = []
    for when in steps:
        rows = posts.filter(when)
        found, days = refresh(rows, path, HASHTAGS)
        assert values(found) == plain(metrics.hashtag_stats(rows))
        seen.append(days)
    assert len(seen[0]) == 9 and set(seen[1]) == {date(2024, 1, 10), None}
    assert min(d for d in seen[2] if d) == date(2024, 1, 10) and None not in seen[2]
    assert refresh(posts, path, HASHTAGS)[1] == []


def test_deleted_days_are_taken_out(posts, tmp_path):
    path = str(tmp_path)
    refresh(posts, path, HASHTAGS)
    rest = posts.filter("processing_time >= '2024-01-20 06:00:00'")
    found, days = refresh(rest, path, HASHTAGS)
    assert days == [date(2024, 1, 20)]
    assert values(found) == plain(metrics.hashtag_stats(rest))
    none, days = refresh(posts.limit(0), path, HASHTAGS)
    assert none.collect() == [] and days == []


def test_a_day_that_changed_without_another_number_of_rows_is_named(posts, tmp_path):
    path, day = str(tmp_path), date(2024, 1, 15)
    refresh(posts, path, HASHTAGS)
    other = posts.withColumn("sentiment", F.when(F.to_date("processing_time") == F.lit(day), F.lit(0.25)).otherwise(F.col("sentiment")))
    assert refresh(other, path, HASHTAGS)[1] == []
    found, days = refresh(other, path, HASHTAGS, [day, date(2030, 1, 1)])
    assert days == [day] and values(found) == plain(metrics.hashtag_stats(other))


def test_spread_and_least_counts(spark, sf, tmp_path):
    aspects = fixtures.aspects(spark, sf)
    far = aspects.withColumn("sentiment", F.col("sentiment") * 1e-3 + 1e3)
    for i, rows in enumerate((aspects, far)):
        path = str(tmp_path / str(i))
        refresh(rows.filter("processing_time < '2024-01-17 03:00:00'"), path, ASPECTS)
        found, _ = refresh(rows, path, ASPECTS)
        assert found.columns[0] == "aspect" and set(found.columns) == set(metrics.aspect_stats(rows).columns)
        assert values(found) == plain(metrics.aspect_stats(rows))


def test_only_the_new_day_is_read(spark, sf, tmp_path, monkeypatch):
    stored, path = str(tmp_path / "posts"), str(tmp_path / "state")
    posts = fixtures.posts(spark, sf).drop("post_id")
    tables.write_batch(posts.filter("processing_time < '2024-01-30'"), 0, stored)
    read = lambda: tables.read_table(spark, stored, posts.schema)
    refresh(read(), path, HASHTAGS)
    tables.write_batch(posts.filter("processing_time >= '2024-01-30'"), 1, stored)
    plans, real = [], increments.day_sums

    def watched(rows, table):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return real(rows, table)

    monkeypatch.setattr(increments, "day_sums", watched)
    found, days = refresh(read(), path, HASHTAGS)
    assert days == [date(2024, 1, 30)] and values(found) == plain(metrics.hashtag_stats(posts))
    assert "PartitionFilters: [isnotnull(dt" in plans[0] and "2024-01-30" in plans[0]
    counted = read().groupBy("dt").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in counted


def test_a_refresh_that_ends_early(posts, tmp_path, monkeypatch):
    path, real = str(tmp_path), increments.day_sums
    refresh(posts.filter("processing_time < '2024-01-20'"), path, HASHTAGS)
    monkeypatch.setattr(increments, "day_sums", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        refresh(posts, path, HASHTAGS)
    monkeypatch.setattr(increments, "day_sums", real)
    found, _ = refresh(posts, path, HASHTAGS)
    assert values(found) == plain(metrics.hashtag_stats(posts))
