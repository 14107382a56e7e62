"""Stored tables, retention and checks."""

import pytest
from pyspark.sql import functions as F

from tagtide import schemas
from tagtide.operators import quality, upkeep
from tagtide.sources import messages, tables

AS_OF = "2024-01-31 00:00:00"


def timed(spark, rows, column="processing_time"):
    df = spark.createDataFrame(rows, f"id int, {column} string")
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def test_upsert_updates_inserts_and_keeps(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("a", 1), ("b", 2)], "hashtag string, n int")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "hashtag string, n int")
    assert tables.upsert_snapshot(old, path, ["hashtag"], "2024-01-01 00:00:00") == 1
    assert tables.upsert_snapshot(new, path, ["hashtag"], "2024-01-02 00:00:00") == 2
    got = {r.hashtag: (r.n, str(r.updated_at)[:10]) for r in tables.read_snapshot(spark, path).collect()}
    assert got == {"a": (1, "2024-01-01"), "b": (20, "2024-01-02"), "c": (30, "2024-01-02")}


def test_repeated_keys_of_an_update(spark, tmp_path):
    path = str(tmp_path / "t")
    twice = spark.createDataFrame([("a", 1, 1), ("a", 2, 3), ("a", 3, 2), ("b", 9, None)], "hashtag string, n int, at int")
    with pytest.raises(ValueError, match="repeat a key"):
        tables.upsert_snapshot(twice, path, ["hashtag"], AS_OF)
    assert tables.runs(spark, path) == []
    tables.upsert_snapshot(twice, path, ["hashtag"], AS_OF, order="at")
    assert {r.hashtag: r.n for r in tables.read_snapshot(spark, path).collect()} == {"a": 2, "b": 9}
    tied = spark.createDataFrame([("a", 4, 9), ("a", 5, 9), ("a", None, 9), ("c", None, None)], "hashtag string, n int, at int")
    tables.upsert_snapshot(tied, path, ["hashtag"], AS_OF, order=["at", "n"])
    got = tables.read_snapshot(spark, path)
    assert got.columns == ["hashtag", "n", "at", "updated_at"]
    assert {r.hashtag: r.n for r in got.collect()} == {"a": 5, "b": 9, "c": None}


def test_a_hot_key_of_an_update_is_combined_before_the_shuffle(spark):
    updates = spark.range(10_000).selectExpr("'a' AS hashtag", "id AS n", "id AS at")
    plan = tables.last_by_key(updates, ["hashtag"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_empty_replacement_is_visible(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "hashtag string, n int")
    assert tables.replace_snapshot(rows.limit(0), path) == 1
    assert tables.read_snapshot(spark, path).collect() == []
    tables.replace_snapshot(rows, path)
    assert tables.replace_snapshot(rows.filter("n > 5"), path) == 3
    found = tables.read_snapshot(spark, path)
    assert found.columns == ["hashtag", "n"] and found.collect() == []


def test_unfinished_run_does_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1)], "hashtag string, n int")
    with pytest.raises(FileNotFoundError):
        tables.read_snapshot(spark, path)
    tables.replace_snapshot(rows, path)
    rows.withColumn("n", F.lit(7)).write.parquet(f"{path}/run=2")
    (tmp_path / "t" / "run=2" / "_SUCCESS").unlink()
    assert [r.n for r in tables.read_snapshot(spark, path).collect()] == [1]
    assert tables.replace_snapshot(rows.withColumn("n", F.lit(8)), path) == 2
    assert [r.n for r in tables.read_snapshot(spark, path).collect()] == [8]


def batch(spark, *times):
    rows = [("u", "c", "t", None, t) for t in times]
    df = spark.createDataFrame(rows, "user_name string, content string, hashtag string, timestamp string, processing_time string")
    return df.withColumn("processing_time", F.col("processing_time").cast("timestamp_ntz"))


def test_empty_first_batch(spark, tmp_path):
    path = str(tmp_path / "posts")
    tables.write_posts(batch(spark, AS_OF).limit(0), 0, path, "simple")
    assert tables.read_table(spark, path).collect() == []
    tables.write_posts(batch(spark, AS_OF), 1, path, "simple")
    assert [(str(r.dt), r.batch_id) for r in tables.read_table(spark, path).collect()] == [("2024-01-31", 1)]


def test_old_days_go_and_the_edge_is_cut(spark, tmp_path):
    path = str(tmp_path / "posts")
    times = ["2024-01-28 23:00:00", "2024-01-29 01:00:00", "2024-01-30 11:59:59", "2024-01-30 12:00:00", "2024-01-30 13:00:00", None]
    tables.write_posts(batch(spark, *times), 0, path, "simple")
    tables.write_posts(batch(spark, *times[2:5]), 1, path, "simple")
    tables.write_posts(batch(spark, "2024-01-30 08:00:00"), 2, path, "simple")
    tables.write_posts(batch(spark, "2024-01-30 18:00:00"), 3, path, "simple")
    young = sorted((tmp_path / "posts" / "dt=2024-01-30" / "batch_id=3").iterdir())
    assert upkeep.delete_old_days(spark, path, "2024-01-31 12:00:00", 1) == 5
    left = sorted((r.batch_id, str(r.processing_time)) for r in tables.read_table(spark, path).collect())
    edge = ["2024-01-30 12:00:00", "2024-01-30 13:00:00"]
    assert left == [*[(0, t) for t in edge], (0, "None"), *[(1, t) for t in edge], (3, "2024-01-30 18:00:00")]
    # A batch without old rows is not written again.
    assert young == sorted((tmp_path / "posts" / "dt=2024-01-30" / "batch_id=3").iterdir())
    assert not (tmp_path / "posts" / "dt=2024-01-30" / "batch_id=2").exists()
    assert upkeep.delete_old_days(spark, path, "2024-01-31 12:00:00", 1) == 0
    assert upkeep.delete_old_days(spark, str(tmp_path / "none"), AS_OF, 1) == 0


def test_retention_that_ends_early_can_be_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "posts")
    times = ["2024-01-28 23:00:00", "2024-01-30 11:00:00", "2024-01-30 13:00:00", None]
    for i in range(2):
        tables.write_posts(batch(spark, *times), i, path, "simple")
    real = upkeep.cut_lineage

    def fails(rows):
        real(rows)
        raise RuntimeError("lost")

    monkeypatch.setattr(upkeep, "cut_lineage", fails)
    with pytest.raises(RuntimeError):
        upkeep.delete_old_days(spark, path, "2024-01-31 12:00:00", 1)
    monkeypatch.setattr(upkeep, "cut_lineage", real)
    assert tables.read_table(spark, path).filter("processing_time >= '2024-01-30 12:00:00'").count() == 2
    assert upkeep.delete_old_days(spark, path, "2024-01-31 12:00:00", 1) == 2
    assert sorted(str(r.processing_time) for r in tables.read_table(spark, path).collect()) == [times[2]] * 2 + ["None"] * 2


def test_whole_days_are_counted_without_a_column(spark, tmp_path):
    path = str(tmp_path / "posts")
    tables.write_posts(batch(spark, "2024-01-28 23:00:00"), 0, path, "simple")
    counted = tables.read_table(spark, path).filter("dt < '2024-01-30'").groupBy().count()
    assert "ReadSchema: struct<>" in counted._jdf.queryExecution().executedPlan().toString()


def test_jdbc_columns_are_those_of_the_variant(spark):
    rows = batch(spark, AS_OF).withColumns({"sentiment": F.lit(0.5), "content_length": F.lit(3.0), "hashtag_count": F.lit(1)})
    assert tables.jdbc_columns(rows, "simple").columns == ["user_name", "content", "hashtag", "processing_time", "timestamp"]
    assert set(tables.jdbc_columns(rows, "basic").columns) == {
        "user_name", "content", "hashtag", "sentiment", "content_length", "hashtag_count", "processing_time", "timestamp",
    }


def test_cleanup_boundary(spark):
    rows = [(1, "2024-01-29 23:59:59"), (2, "2024-01-30 00:00:00"), (3, None)]
    given = {
        "posts": timed(spark, rows),
        "aspect_sentiments": timed(spark, rows[1:]),
        "anomaly_detection": timed(spark, rows, "detected_at"),
    }
    kept, removed = upkeep.cleanup(given, AS_OF, 1)
    assert {r.table_name: r.rows_deleted for r in removed.collect()} == {"posts": 1, "aspect_sentiments": 0, "anomaly_detection": 1}
    assert sorted(r.id for r in kept["posts"].collect()) == [2, 3]


def test_batch_is_replaced_not_doubled(spark, tmp_path):
    path = str(tmp_path / "posts")
    rows = spark.createDataFrame(
        [("u", "c", "t", "2024-01-30T10:00:00+02:00")], "user_name string, content string, hashtag string, timestamp string"
    ).withColumn("processing_time", F.lit(AS_OF).cast("timestamp_ntz"))
    for batch in (0, 1, 1):
        tables.write_posts(rows, batch, path, "simple")
    stored = tables.read_table(spark, path)
    assert stored.count() == 2
    assert {"dt", "batch_id"} <= set(stored.columns)
    first = stored.first()
    assert first.sentiment is None and str(first.timestamp) == "2024-01-30 10:00:00"
    pruned = tables.posts_since(stored, AS_OF, "1 hour")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in pruned


def test_struct_variant_fills_zeros(spark):
    rows = spark.createDataFrame(
        [("u", "c", "t", None, None, None, "s", None, None)],
        "user_name string, content string, hashtag string, overall_sentiment float, content_length float,"
        " hashtag_count int, sentiment_summary string, top_aspect string, top_aspect_sentiment float",
    ).withColumns({c: F.lit(AS_OF).cast("timestamp_ntz") for c in ("processing_time", "timestamp")})
    row = tables.posts_columns(rows, "struct").first()
    assert (row.sentiment, row.content_length, row.hashtag_count, row.top_aspect_sentiment) == (0.0, 0.0, 0, 0.0)
    assert tables.posts_columns(rows, "struct").schema.simpleString() == schemas.POSTS.simpleString()


def test_validation_reasons(spark):
    rows = spark.createDataFrame([("u", "t"), (None, "t"), ("u", "x" * 256), (None, None)], "user_name string, hashtag string")
    good, bad = quality.validate_posts(rows)
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == [
        "hashtag longer than 255",
        "user_name is null",
        "user_name is null; hashtag is null",
    ]


def test_conform_renames_or_adds(spark):
    old = spark.createDataFrame([("u", 1)], "user string, extra int")
    got = quality.conform_schema(old, schemas.RAW_MESSAGE)
    assert got.columns == ["user_name", "content", "hashtags", "timestamp", "extra"]
    assert got.first().user_name == "u"
    assert quality.conform_schema(old.drop("user"), schemas.RAW_MESSAGE).first().user_name is None


def test_duplicate_keys(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "hashtag string, community_id int")
    assert [tuple(r) for r in quality.duplicate_keys(rows, schemas.KEYS["hashtag_communities"]).collect()] == [("a", 1, 2)]


def test_statuses_and_processed_messages(spark):
    raw = spark.createDataFrame(
        [('{"user":"u","content":"c","hashtag":"h","timestamp":"t"}', 1), ('{"user":"u","content":"c"}', 2), ("{bad", 3)],
        "value string, offset int",
    )
    assert [r.offset for r in messages.valid_messages(raw).collect()] == [1]
    status = spark.createDataFrame([([("a",), ("b",)], ("u",), "c", "t"), ([], ("u",), "c", "t")], schemas.RAW_STATUS)
    assert [tuple(r) for r in messages.normalize_status(status).collect()] == [("u", "c", ["a", "b"], "t")]


def test_explode_counts(spark):
    rows = spark.createDataFrame([(["x", "x", "y"],), ([],), (None,)], "hashtags array<string>")
    assert [r.hashtag for r in messages.explode_hashtags(rows).collect()] == ["x", "x", "y"]


def test_jdbc_writer_options(spark, monkeypatch):
    """No database here: only what reaches the writer is checked."""
    seen = {}

    class Writer:
        def format(self, name):
            seen["format"] = name
            return self

        def mode(self, name):
            seen["mode"] = name
            return self

        def options(self, **kw):
            seen.update(kw)
            return self

        def save(self):
            seen["saved"] = True

    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.write", property(lambda self: seen.setdefault("columns", self.columns) and Writer()))
    rows = spark.createDataFrame([("u", ["a"])], "user_name string, hashtags array<string>")
    tables.write_jdbc(rows, "jdbc:x://h/db", "posts", {"user": "me"})
    assert seen == {
        "columns": ["user_name"], "format": "jdbc", "mode": "append", "url": "jdbc:x://h/db",
        "dbtable": "posts", "user": "me", "saved": True,
    }


def test_round_tables_are_deleted(spark):
    from tagtide.session import clear_scratch, cut_lineage, folders, shared_dir

    first = cut_lineage(spark.range(3).toDF("n"))
    second = cut_lineage(first.selectExpr("n + 1 AS n"), replaces=first)
    assert [r.n for r in second.orderBy("n").collect()] == [1, 2, 3]
    names = folders(spark, shared_dir(spark))
    assert first.scratch_path.split("/")[-1] not in names and second.scratch_path.split("/")[-1] in names
    assert clear_scratch(spark) >= 1
    assert not any(n.startswith("table-") for n in folders(spark, shared_dir(spark)))
