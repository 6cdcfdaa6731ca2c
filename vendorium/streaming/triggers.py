"""What the triggers of a stream did: batches with rows, and triggers that found nothing to do."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)


class TriggerCounts(StreamingQueryListener):
    """Counts progress and idle events of all queries of a session; an idle trigger writes nothing and logs no run."""

    def __init__(self) -> None:
        self.batches, self.rows, self.idle, self.ended = 0, 0, 0, 0
        self._listens = False

    def listen(self, spark: SparkSession) -> None:
        if not self._listens:
            spark.streams.addListener(self)
            self._listens = True

    def stop(self, spark: SparkSession) -> None:
        if self._listens:
            spark.streams.removeListener(self)
            self._listens = False

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        if event.progress.numInputRows:
            self.batches += 1
            self.rows += event.progress.numInputRows
        else:
            self.idle += 1

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        self.idle += 1

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self.ended += 1
