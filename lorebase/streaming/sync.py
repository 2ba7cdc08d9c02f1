"""Index documents that were added since the last run, then stop."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame

from lorebase.session import drop_scratch, scratch_path
from lorebase.sources.kb import dealt_versions, write_segment


def run_kb_sync(docs: DataFrame, path: str, checkpoint: str) -> None:
    """`docs` streams (doc_id, content, updated_at, seq); each micro-batch becomes one index segment.

    Of several versions of a document the latest counts, in whatever batch or stream it comes. A segment is named after
    the stream's id, which lives in its checkpoint, and the batch: a batch that is repeated after a failure replaces
    its own segment, and another stream into the same index has segments of its own.
    """
    stream: list[str] = []
    started = threading.Event()

    def index(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        spark = batch.sparkSession
        held = scratch_path(spark, "versions")
        write_segment(dealt_versions(batch, held), path, f"stream-{stream[0]}-{batch_id}", batch_id)
        drop_scratch(spark, held)

    query = (
        docs.select("doc_id", "content", "updated_at", "seq")
        .writeStream.foreachBatch(index)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.append(str(query.id))
    started.set()
    query.awaitTermination()
