"""Incremental upkeep as streams: the search index, and the newest status of each question."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folium.sources.postings import Index


def keep_index(changes: DataFrame, index: Index, checkpoint: str, merge_beyond: int = 16) -> StreamingQuery:
    """Keep an index in step with a stream of (key, text): new and changed texts come in, null texts take theirs away.

    A batch is one generation under its own number among the batches, so that one that runs again changes nothing;
    beyond so many generations they are merged.
    """

    def follow(batch: DataFrame, number: int) -> None:
        # merges take odd numbers behind those of the batches that they stand for
        index.apply(batch.select("key", "text"), 2 * number)
        if len(index.generations()) > merge_beyond:
            index.merge()

    return changes.writeStream.foreachBatch(follow).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest_status(reviews: DataFrame, delay: str = "1 day") -> DataFrame:
    """(question_id, status, validated_at) of a stream of reviews; update mode emits a question when its newest changes."""
    rows = reviews.withWatermark("validated_at", delay)
    return rows.groupBy("question_id").agg(F.max(F.struct("validated_at", "status")).alias("x")).select("question_id", "x.status", "x.validated_at")


def review_rates(reviews: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """(window, status, n): reviews of each status by time; late ones are counted within the delay."""
    rows = reviews.withWatermark("validated_at", delay)
    return rows.groupBy(F.window("validated_at", window), "status").agg(F.count("*").alias("n"))
