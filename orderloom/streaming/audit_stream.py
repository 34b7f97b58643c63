"""Streaming form of the mirrored audit log."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.audit import append_audit


def mirror_stream(
    entries: DataFrame,
    log_path: str,
    mirror_path: str,
    checkpoint: str,
    once: bool = True,
) -> StreamingQuery:
    """Append a stream of audit entries to the log and its mirror.

    Each micro-batch becomes one folder named after the stream's persistent id
    and its number. A batch that is replayed after a failure replaces its own
    folders, so both sinks hold every entry exactly once; another stream, or the
    same with a new checkpoint, has another id and replaces nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        stored = batch.sparkSession.read.text(f"{checkpoint}/metadata").first()
        stream = json.loads(stored[0])["id"]
        append_audit(batch, log_path, mirror_path, batch_id=f"stream-{stream}-{number:012d}")

    writer = entries.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
