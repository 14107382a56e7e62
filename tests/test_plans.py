"""What the plans of the queries must and must not hold."""

import pytest

from tagtide.plans.catalog import QUERIES

WRITES_WHILE_BUILT = ("stream", "sink", "write", "snapshot", "run", "views", "central", "between", "pagerank", "communit", "cluster")
LAZY = [n for n in sorted(QUERIES) if not any(w in n for w in WRITES_WHILE_BUILT)]


def plan(spark, sf, name):
    return QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, sf, name):
    text = plan(spark, sf, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow", "Exchange RoundRobin"):
        assert bad not in text


def test_window_reaches_the_scan(spark, sf):
    text = plan(spark, sf, "hourly_sentiment_volume")
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-30T00:00)]" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in text


def test_only_used_columns_are_read(spark, sf):
    # The two tags of an event are built from its type and properties; its value is not needed.
    schema = "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>"
    assert schema in plan(spark, sf, "user_hourly_history")
    assert "ReadSchema: struct<props:string>" in plan(spark, sf, "aspect_counts")


def test_reports_keep_k_rows_per_task(spark, sf):
    for name in ("top_hashtags", "top_users", "velocity_top50"):
        assert "TakeOrderedAndProject" in plan(spark, sf, name)
    assert "WindowGroupLimit" in plan(spark, sf, "top_aspects_by_intensity")


def test_row_wise_text_jobs_do_not_shuffle(spark, sf):
    from tagtide.operators import texts
    from tagtide.sources import fixtures

    documents = fixtures.table(spark, sf, "documents").selectExpr("doc_id AS post_id", "text AS content", "array(lang) AS hashtags")
    for job in (texts.post_sentiment, texts.aspect_sentiments, texts.enrich_aspects, texts.rich_analysis):
        assert "Exchange" not in job(documents)._jdf.queryExecution().executedPlan().toString()
