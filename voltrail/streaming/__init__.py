"""Structured Streaming jobs over arriving files."""

from pyspark.sql import DataFrame

# A backlog is worked off in batches of this many files, so a failure costs one batch.
FILES_PER_BATCH = 10_000


def stream_id(batch: DataFrame, name: str) -> str:
    """Name of the running stream, unlike that of any stream with another checkpoint.

    The id is kept in the checkpoint: a restart has the same, so a batch played
    again finds what it wrote; a stream begun anew cannot replace older loads.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("not inside a streaming batch")
    return f"{name}-{query}"
