"""Queries over tables that are folders of files, and over single files: the same rows."""

import pytest

from tagtide.plans.catalog import QUERIES

DOCUMENTS = [(i, f"I love part {i}. The rest is bad.", "en", f"src{i % 2}", 30) for i in range(1, 12)]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def written(spark, folder, files):
    documents = spark.createDataFrame(DOCUMENTS, COLUMNS)
    benchmark = spark.createDataFrame([(1, "I love the rest")], "item_id long, text string")
    benchmark.coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    documents.repartition(files).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def one_file(spark, folder):
    """The documents as a single file, beside a file of a similar name."""
    whole = written(spark, folder / "whole", 1)
    (part,) = (folder / "whole" / "documents.parquet").glob("part-*.parquet")
    (folder / "single").mkdir()
    for name in ("documents.parquet", "documents.parquets"):
        (folder / "single" / name).write_bytes(part.read_bytes())
    (part,) = (folder / "whole" / "benchmark.parquet").glob("part-*.parquet")
    (folder / "single" / "benchmark.parquet").write_bytes(part.read_bytes())
    return whole, str(folder / "single")


def test_streams_read_folders_and_files(spark, tmp_path):
    folders = [written(spark, tmp_path / "parts", 3), *one_file(spark, tmp_path)]
    rows = [sorted(map(str, QUERIES["ingest_stream"](spark, folder).collect())) for folder in folders]
    assert rows[0] and rows[0] == rows[1] == rows[2]


@pytest.mark.parametrize("name", ["ingest_stream_lexicon", "dual_sink"])
def test_other_sinks_read_folders(spark, tmp_path, name):
    assert QUERIES[name](spark, written(spark, tmp_path / "parts", 3)).count() > 0


def test_hashtag_context_is_computed_once(spark, tmp_path):
    found = QUERIES["rich_hashtag_context"](spark, written(spark, tmp_path, 1))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Filter" in line and "map_from_entries" in line]
    assert found.count() == 2 * len(DOCUMENTS)
