"""Streams over small files: same rows as the batch, replays, late rows."""

import json
import os


from tagtide.sources import messages, tables
from tagtide.streaming import ingest, windows

NOW = {"availableNow": True}
AS_OF = "2024-01-31 00:00:00"


def message(user, tags, content="I love it"):
    return json.dumps({"user_name": user, "content": content, "hashtags": tags, "timestamp": "2024-01-30T10:00:00Z"})


LINES = [
    [message("u1", ["a", "b"]), message("u2", ["a"]), "{bad"],
    [message(None, ["c"]), message("u3", []), message("u4", "not a list")],
]


def raw_files(tmp_path, files=LINES):
    folder = tmp_path / "raw"
    folder.mkdir()
    for i, lines in enumerate(files):
        (folder / f"{i}.txt").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_ingest_files(spark, tmp_path):
    raw = messages.read_raw(spark, "text", raw_files(tmp_path), maxFilesPerTrigger="1")
    out = str(tmp_path / "out")
    sinks = [ingest.posts_sink(f"{out}/posts", "aspects"), ingest.aspects_sink(f"{out}/aspects"), ingest.processed_sink(f"{out}/sent")]
    rows = ingest.ingest(raw, "aspects", now=AS_OF)
    ingest.start_ingest(rows, sinks, str(tmp_path / "cp"), NOW, name="ingest").awaitTermination()

    posts = tables.read_table(spark, f"{out}/posts")
    assert sorted((str(r.user_name), r.hashtag) for r in posts.collect()) == [("None", "c"), ("u1", "a"), ("u1", "b"), ("u2", "a")]
    assert {r.batch_id for r in posts.collect()} == {0, 1}
    sent = [json.loads(r.value) for r in spark.read.text(f"{out}/sent").collect()]
    assert len(sent) == 4 and all("user_name" not in m or m["user_name"] for m in sent)

    # Nothing new: a second run adds nothing.
    ingest.start_ingest(rows, sinks, str(tmp_path / "cp"), NOW).awaitTermination()
    assert tables.read_table(spark, f"{out}/posts").count() == 4


def test_batch_is_computed_once_and_unfolded_from_what_was_written(spark, tmp_path):
    from tagtide.session import folders, shared_dir

    raw = messages.read_raw(spark, "text", raw_files(tmp_path))
    out, prepared = str(tmp_path / "out"), []

    def prepare(batch):
        prepared.append(batch.rdd.getNumPartitions())
        return ingest.ingest(batch, "aspects", now=AS_OF, explode=False)

    before = set(folders(spark, shared_dir(spark)))
    sinks = [ingest.posts_sink(f"{out}/posts", "aspects"), ingest.processed_sink(f"{out}/sent")]
    ingest.start_ingest(
        raw, sinks, str(tmp_path / "cp"), NOW, prepare=prepare, unfold=messages.explode_hashtags, tasks=5
    ).awaitTermination()
    got = sorted((str(r.user_name), r.hashtag) for r in tables.read_table(spark, f"{out}/posts").collect())
    assert got == [("None", "c"), ("u1", "a"), ("u1", "b"), ("u2", "a")] and prepared == [5]
    assert spark.read.text(f"{out}/sent").count() == 4
    # The written batch is gone once the sinks are done.
    assert not [n for n in set(folders(spark, shared_dir(spark))) - before if n.startswith("table-")]


def test_variants_stream_like_the_batch(spark, tmp_path):
    folder = raw_files(tmp_path)
    batch = spark.read.text(folder)
    for variant in ("plain", "simple", "basic", "struct"):
        expected = ingest.ingest(batch, variant, now=AS_OF).select("user_name", "hashtag").collect()
        path = str(tmp_path / variant)
        rows = ingest.ingest(messages.read_raw(spark, "text", folder), variant, now=AS_OF)
        ingest.start_ingest(rows, [ingest.processed_sink(path)], str(tmp_path / f"cp-{variant}"), NOW).awaitTermination()
        assert spark.read.text(path).count() == len(expected) == 4


def test_legacy_messages(spark, tmp_path):
    line = json.dumps({"user": "old", "content": "c", "hashtags": ["t"], "timestamp": "x"})
    rows = ingest.ingest(spark.createDataFrame([(line,)], "value string"), "plain", legacy=True)
    assert [(r.user_name, r.hashtag) for r in rows.collect()] == [("old", "t")]


def test_failed_sink_fails_the_query(spark, tmp_path):
    raw = messages.read_raw(spark, "text", raw_files(tmp_path))
    out = str(tmp_path / "posts")

    def broken(rows, batch_id):
        raise ValueError("sink is down")

    rows = ingest.ingest(raw, "basic", now=AS_OF)
    query = ingest.start_ingest(rows, [ingest.posts_sink(out), broken], str(tmp_path / "cp"), NOW)
    try:
        query.awaitTermination()
        failed = False
    except Exception:  # noqa: BLE001
        failed = True
    assert failed
    # The batch was not lost: it runs again and replaces what was written.
    ingest.start_ingest(rows, [ingest.posts_sink(out)], str(tmp_path / "cp"), NOW).awaitTermination()
    assert tables.read_table(spark, out).count() == 4


def event_files(spark, tmp_path, files):
    """A stream of (time, tag, sentiment) rows, one file per micro-batch."""
    folder = tmp_path / "events"
    folder.mkdir()
    for i, rows in enumerate(files):
        lines = [json.dumps({"processing_time": t, "hashtag": h, "sentiment": s}) for t, h, s in rows]
        (folder / f"{i}.json").write_text("\n".join(lines) + "\n")
        # Files are taken in the order of their times.
        os.utime(folder / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    source = (
        spark.readStream.schema("processing_time timestamp_ntz, hashtag string, sentiment double")
        .option("maxFilesPerTrigger", "1")
        .json(str(folder))
    )
    return windows.event_time(source)


def test_late_row_is_dropped(spark, tmp_path):
    live = event_files(
        spark, tmp_path,
        [
            [("2024-01-30T10:00:10", "a", 1.0), ("2024-01-30T10:30:00", "a", 0.0)],
            [("2024-01-30T10:30:30", "b", 0.5)],
            # The watermark of the first batch applies to late rows from the third on.
            [("2024-01-30T10:00:20", "a", 0.0), ("2024-01-30T10:25:00", "a", 0.0)],
        ],
    )
    out = str(tmp_path / "out")
    windows.start_windows(windows.stream_posts_per_minute(live), out, str(tmp_path / "cp"), NOW).awaitTermination()
    got = {str(r.time)[11:16]: (r.posts_count, r.avg_sentiment) for r in windows.read_windows(spark, out, ["time"]).collect()}
    assert got == {"10:00": (1, 1.0), "10:25": (1, 0.0), "10:30": (2, 0.25)}


def test_top_hashtags_over_batches(spark, tmp_path):
    """Minutes that arrive in different batches meet in the windows they share."""
    live = event_files(
        spark, tmp_path,
        [
            [("2024-01-30T10:00:10", "a", 0.0), ("2024-01-30T10:00:20", "b", 0.0), ("2024-01-30T10:20:00", "b", 0.0)],
            [("2024-01-30T10:21:00", "c", 0.0), ("2024-01-30T10:40:00", "c", 0.0)],
            [("2024-01-30T11:05:00", "a", 0.0), ("2024-01-30T11:05:30", "a", 0.0), ("2024-01-30T11:30:00", "z", 0.0)],
        ],
    )
    out = str(tmp_path / "out")
    windows.start_top_hashtags(live, out, str(tmp_path / "cp"), k=2, trigger=NOW).awaitTermination()
    rows = spark.read.parquet(f"{out}/top").collect()
    by_end = {}
    for r in sorted(rows, key=lambda r: (r.window_end, r["rank"])):
        by_end.setdefault(str(r.window_end)[11:16], []).append((r.hashtag, r["count"]))
    assert by_end["10:01"] == [("a", 1), ("b", 1)]
    assert by_end["10:22"] == [("b", 2), ("a", 1)]
    assert by_end["11:00"] == [("b", 2), ("c", 2)]
    assert by_end["11:01"] == [("c", 2), ("b", 1)]
    assert by_end["11:06"] == [("a", 2), ("c", 2)]
    assert max(by_end) == "11:06"
    # The last minutes come out when the input is known to have ended, once.
    for _ in range(2):
        windows.finish_top_hashtags(spark, out, str(tmp_path / "cp"), k=2)
    rows = spark.read.parquet(f"{out}/top").filter("window_end > '2024-01-30 11:06:00'").collect()
    ends = sorted({str(r.window_end)[11:16] for r in rows})
    assert ends[0] == "11:07" and ends[-1] == "11:31" and len(ends) == 25
    last = sorted((r["rank"], r.hashtag, r["count"]) for r in rows if str(r.window_end)[11:16] == "11:31")
    assert last == [(1, "a", 2), (2, "c", 1)]
