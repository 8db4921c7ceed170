"""Where streams go. Every writer has a checkpoint and resumes from it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.files import Files
from millrace.versioned.table import CommitConflict, VersionedTable


def _started(writer: DataStreamWriter, finish: bool) -> StreamingQuery:
    """With ``finish`` the query takes what is there and ends, else it goes on."""
    if not finish:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def to_console(stream: DataFrame, rows: int = 20) -> StreamingQuery:
    """Show each batch; for looking at a stream, not for keeping it."""
    return stream.writeStream.outputMode("append").format("console").option("numRows", rows).start()


def to_parquet(stream: DataFrame, path: str, checkpoint: str, finish: bool = False) -> StreamingQuery:
    """Append to a Parquet folder."""
    writer = stream.writeStream.outputMode("append").format("parquet")
    return _started(writer.option("path", path).option("checkpointLocation", checkpoint), finish)


def to_versioned(
    stream: DataFrame, path: str, checkpoint: str, finish: bool = False, output_mode: str = "append"
) -> StreamingQuery:
    """Commit each batch to a versioned table: appended, or as its new content in complete mode.

    The commit records the batch number under the query's id, which the checkpoint
    keeps: a batch repeated after a failure is not committed twice, while a new
    checkpoint starts a new query.
    """
    spark = stream.sparkSession
    table = VersionedTable(spark, path)
    if not table.exists():
        try:
            VersionedTable.create(spark.createDataFrame([], stream.schema), path)
        except CommitConflict:
            # Created by another writer in between, which is as good.
            table.latest()

    def commit(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        query_id = json.loads(Files(session, checkpoint).read_text("metadata"))["id"]
        write = VersionedTable.overwrite if output_mode == "complete" else VersionedTable.append
        write(VersionedTable(session, path), rows, batch=(query_id, number))

    writer = stream.writeStream.outputMode(output_mode).foreachBatch(commit)
    return _started(writer.option("checkpointLocation", checkpoint), finish)
