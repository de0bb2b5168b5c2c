"""Is a running stream fresh? A listener keeps what each query last said, and when it last had rows."""

from __future__ import annotations

from datetime import datetime
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import (
    QueryIdleEvent, QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener)

from tally.streaming.snapshots import freshness

EVENTS = "query string, kind string, at timestamp_ntz, rows bigint"


def _time(text: str) -> datetime:
    return datetime.fromisoformat(text.replace("Z", "+00:00")).replace(tzinfo=None)


class FreshnessListener(StreamingQueryListener):
    """Collects events of all queries of a session: one entry for each query and kind, the newest.

    ``progress`` is a batch with rows, ``empty`` one without, ``idle`` a trigger that found nothing,
    ``started`` and ``ended`` are what they say. Times are Spark's, in UTC. What is kept does not grow
    with the number of events; ``rows`` sums up what a query has read.
    """

    def __init__(self) -> None:
        self._lock, self._seen, self._rows = Lock(), {}, {}

    def _note(self, query: str, kind: str, at: datetime, rows: int = 0) -> None:
        with self._lock:
            self._rows[query] = self._rows.get(query, 0) + rows
            self._seen[query, kind] = max(at, self._seen.get((query, kind), at))

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self._note(event.name or str(event.id), "started", _time(event.timestamp))

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        self._note(p.name or str(p.id), "progress" if p.numInputRows else "empty", _time(p.timestamp), p.numInputRows)

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        self._note(str(event.id), "idle", _time(event.timestamp))

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        pass  # an ended query has no news; its age goes on

    def rows_read(self) -> int:
        """Rows that all queries have read, as far as events have arrived: they come a little after the batch."""
        with self._lock:
            return sum(self._rows.values())

    def events(self, spark: SparkSession) -> DataFrame:
        """(``query``, ``kind``, ``at``, ``rows``): the newest event of each kind, and rows read by the query."""
        with self._lock:
            rows = [(q, k, t, self._rows[q]) for (q, k), t in self._seen.items()]
        return spark.createDataFrame(rows, EVENTS)

    def status(self, spark: SparkSession, now: datetime, max_age: int = 120) -> DataFrame:
        """Age and ``stale`` of each query at ``now``: seconds since it last had rows, or since its start if it never had."""
        news = self.events(spark).filter(F.col("kind").isin("progress", "started"))
        return freshness(news, "at", F.lit(now).cast("timestamp_ntz"), max_age, ["query"])
