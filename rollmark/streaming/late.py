"""Rows that a watermark drops: counted as Spark reports them, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql.streaming import StreamingQueryListener

OnMetrics = Callable[[int, dict], None]


class LateRows(StreamingQueryListener):
    """Gives ``on_metrics(batch_id, {"late": n})`` after each batch of the query of this name. The report
    comes when the batch is done, so later than what the batch itself gives."""

    def __init__(self, name: str, on_metrics: OnMetrics):
        self._name, self._on_metrics = name, on_metrics

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name == self._name and progress.stateOperators:
            late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
            self._on_metrics(progress.batchId, {"late": late})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
