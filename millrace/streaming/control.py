"""A running query, driven and looked at from outside."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery


class Watched:
    """Takes in what has arrived, batch by batch, and reports on it; stops the query on leaving."""

    def __init__(self, query: StreamingQuery):
        self.query = query

    def __enter__(self) -> Watched:
        return self

    def __exit__(self, *_) -> None:
        self.stop()

    @property
    def active(self) -> bool:
        return self.query.isActive

    def take(self) -> None:
        """Wait until everything that is there now is in the sink; the query goes on. Raises what made it fail."""
        self.query.processAllAvailable()

    def progress(self) -> tuple[int, int]:
        """(batches with rows, rows) since this query was started, as far as Spark keeps its reports."""
        rows = [p.numInputRows for p in self.query.recentProgress]
        return sum(n > 0 for n in rows), sum(rows)

    def stop(self) -> None:
        """End the query after the batch in hand; its checkpoint lets another one go on."""
        self.query.stop()
        self.query.awaitTermination()
