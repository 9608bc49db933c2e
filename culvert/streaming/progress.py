"""What the progress of a query tells about its source."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

#: (topic, partition, lag) of every partition of a batch.
Lag = list[tuple[str, int, float]]


def source_lag(progress: str) -> Lag:
    """How far each partition is behind its end after a batch, from the progress as JSON.

    A Kafka source tells the offsets a batch began and ended at, and the ends of the
    partitions when it was planned. A partition without records in the batch is not
    behind; other sources have no partitions.
    """
    found: Lag = []
    for source in json.loads(progress).get("sources", []):
        ends, latest = _offsets(source.get("endOffset")), _offsets(source.get("latestOffset"))
        begins = _offsets(source.get("startOffset"))
        for (topic, partition), end in ends.items():
            read = end > begins.get((topic, partition), 0)
            behind = max(0, latest.get((topic, partition), end) - end) if read else 0
            found.append((topic, partition, float(behind)))
    return sorted(found)


def _offsets(given: object) -> dict[tuple[str, int], int]:
    if isinstance(given, str):
        try:
            given = json.loads(given)
        except ValueError:
            return {}
    if not isinstance(given, dict) or not all(isinstance(v, dict) for v in given.values()):
        return {}
    return {(topic, int(p)): int(n) for topic, parts in given.items() for p, n in parts.items() if str(p).isdigit()}


class LagListener(StreamingQueryListener):
    """Tells ``report(batch_id, lag)`` after every batch of a query on Kafka."""

    def __init__(self, report: Callable[[int, Lag], None]):
        self.report = report

    def onQueryStarted(self, event: QueryStartedEvent) -> None: ...

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        lag = source_lag(event.progress.json)
        if lag:
            self.report(event.progress.batchId, lag)

    def onQueryIdle(self, event: QueryIdleEvent) -> None: ...

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None: ...
