"""Documents upserted from a stream."""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickloom.sinks.documents import append_documents, compact_documents, count_days
from clickloom.streaming.queries import triggered


def first_deliveries(documents: DataFrame, bound: str = "1 day") -> DataFrame:
    """A stream of documents without those that were delivered before, as far as they come within
    ``bound`` of event time.

    The state holds one id per document and forgets it behind the watermark; what is delivered
    again later passes, and is resolved where the table is read, as all of it would be without this.
    """
    return documents.withWatermark("event_ts", bound).dropDuplicatesWithinWatermark(["index_date", "doc_id"])


def start_documents(
    documents: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    compact_every: int | None = None,
    counts: str | None = None,
) -> StreamingQuery:
    """Write typed documents batch by batch; a repeated batch replaces its own partitions.

    Deliveries carry the query's id, which lives in its checkpoint: a new checkpoint is a new
    writer, so its batches, numbered from 0 again, replace nothing. Every ``compact_every``
    batches the table is compacted, so that its folders stay few. At ``counts``, a keyed table,
    the documents of every day that a batch touches are counted again.
    """
    started: Future[str] = Future()

    def deliver(batch: DataFrame, batch_id: int) -> None:
        delivery = append_documents(batch, path, batch_id, started.result())
        if counts is not None:
            count_days(batch.sparkSession, path, delivery, counts, batch_id)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_documents(batch.sparkSession, path)

    writer = documents.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    query = triggered(writer, interval).start()
    started.set_result(str(query.id))
    return query
