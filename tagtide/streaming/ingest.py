"""From the raw topic to the posts table and the processed topic, in one query.

Parsing, scoring and exploding are expressions, so the same functions serve batch and
stream. Each micro-batch is computed once and written to every sink.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagtide.functions.sentiment import score_simple
from tagtide.functions.times import AsOf
from tagtide.operators.texts import enrich_aspects, enrich_basic, enrich_struct
from tagtide.session import cut_lineage, delete_folder
from tagtide.sources.messages import explode_hashtags, parse_legacy_messages, parse_messages, to_kafka_value
from tagtide.sources.tables import jdbc_columns, write_aspects, write_jdbc, write_posts

Sink = Callable[[DataFrame, int], None]


def ingest(
    raw: DataFrame,
    variant: str = "basic",
    scorer=score_simple,
    now: AsOf = None,
    legacy: bool = False,
    lexicon: DataFrame | None = None,
    gazetteer: DataFrame | None = None,
    explode: bool = True,
) -> DataFrame:
    """Raw values to enriched rows, one per tag, or one per message if they are not to ``explode``.

    ``variant``: ``simple`` adds the processing time only and ``plain`` nothing;
    ``basic``, ``aspects`` and ``struct`` add the features of those consumers. Works on batches
    and streams; with a ``lexicon`` or ``gazetteer`` to look words up in, on batches, and so on a
    stream as the ``prepare`` of ``start_ingest``.
    """
    messages = parse_legacy_messages(raw) if legacy else parse_messages(raw)
    if variant == "plain":
        rows = messages
    elif variant == "simple":
        rows = enrich_basic(messages, scorer, now).drop("sentiment", "content_length", "hashtag_count")
    elif variant == "basic":
        rows = enrich_basic(messages, scorer, now, lexicon)
    elif variant == "aspects":
        rows = enrich_aspects(messages, scorer, now, lexicon=lexicon)
    elif variant == "struct":
        rows = enrich_struct(messages, scorer, now, lexicon, gazetteer)
    else:
        raise ValueError(f"unknown variant {variant!r}")
    return explode_hashtags(rows) if explode else rows


def posts_sink(path: str, variant: str = "basic") -> Sink:
    """Rows of the posts table, in a folder per batch."""
    return lambda rows, batch_id: write_posts(rows, batch_id, path, variant)


def aspects_sink(path: str) -> Sink:
    """One row per exploded post and aspect."""
    return lambda rows, batch_id: write_aspects(rows, batch_id, path)


def processed_sink(path: str) -> Sink:
    """The processed messages as JSON lines, in a folder per batch."""

    def write(rows: DataFrame, batch_id: int) -> None:
        to_kafka_value(rows).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


def kafka_sink(bootstrap: str, topic: str, **options: str) -> Sink:
    """The processed messages to a Kafka topic.

    Appends: a batch that runs again is sent again (at least once). Put this sink last.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        settings = {"kafka.bootstrap.servers": bootstrap, "topic": topic, **options}
        to_kafka_value(rows).write.format("kafka").options(**settings).save()

    return write


def jdbc_sink(url: str, table: str, properties: dict[str, str], variant: str = "basic") -> Sink:
    """Rows of the posts table to a database, in the columns that the variant's table has.

    Appends: a batch that runs again is appended again (at least once). Put this sink last.
    """
    return lambda rows, batch_id: write_jdbc(jdbc_columns(rows, variant), url, table, properties)


def batch_writer(
    sinks: Sequence[Sink],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    unfold: Callable[[DataFrame], DataFrame] | None = None,
    tasks: int | None = None,
) -> Sink:
    """One ``foreachBatch`` function for all sinks.

    ``prepare`` turns a batch into the rows to write, and may join it with tables; a batch that
    comes in few splits is dealt to ``tasks`` before. For several sinks its result is computed
    once and written to the shared folder; ``unfold`` (such as ``explode_hashtags``) is applied to what
    was written, so that copies of a message are made only where they are read. An error fails the
    query, so the batch runs again after a restart; sinks that own a folder per batch then
    replace what was written.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        if tasks:
            rows = rows.repartition(tasks, F.xxhash64(*rows.columns))
        if prepare:
            rows = prepare(rows)
        written = None
        if len(sinks) > 1:
            rows = written = cut_lineage(rows)
        if unfold:
            rows = unfold(rows)
        try:
            for sink in sinks:
                sink(rows, batch_id)
        finally:
            if written is not None:
                delete_folder(written.sparkSession, written.scratch_path)

    return write


def start_ingest(
    rows: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    unfold: Callable[[DataFrame], DataFrame] | None = None,
    tasks: int | None = None,
) -> StreamingQuery:
    """Start the query. ``rows`` are ingested, or raw with ``prepare`` to ingest each batch.

    ``prepare``, ``unfold`` and ``tasks`` as in ``batch_writer``; ``trigger`` as in ``writeStream.trigger``, e.g. ``{"availableNow": True}``.
    """
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.foreachBatch(batch_writer(sinks, prepare, unfold, tasks)).start()
