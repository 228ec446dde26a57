"""What a running stream reports of itself, as measures for alerts."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

MEASURE = "window_start timestamp, metric string, num long, den long"


def progress_measures(progress: dict, trigger_seconds: int | None) -> list[tuple]:
    """(window_start, metric, num, den) of one batch, from its progress report.

    utilization: time the batch took of the trigger interval; processing_lag_seconds: start of the batch -
    newest event time in it; late_rows: rows that the watermark dropped, of all rows read.
    """
    def moment(text):
        return datetime.fromisoformat(text.replace("Z", "+00:00"))

    at, rows = moment(progress["timestamp"]), int(progress.get("numInputRows") or 0)
    out = []
    took = (progress.get("durationMs") or {}).get("triggerExecution")
    if trigger_seconds and took is not None:
        out.append((at, "utilization", int(took), 1000 * trigger_seconds))
    newest = (progress.get("eventTime") or {}).get("max")
    if newest:
        out.append((at, "processing_lag_seconds", int((at - moment(newest)).total_seconds()), 1))
    late = sum(int(s.get("numRowsDroppedByWatermark") or 0) for s in progress.get("stateOperators") or [])
    if rows:
        out.append((at, "late_rows", late, rows))
    return out


class ProgressLog(StreamingQueryListener):
    """Collects the measures of every batch of the queries with a given name (all without one)."""

    def __init__(self, trigger_seconds: int | None = None, name: str | None = None, keep: int = 10_000):
        self.trigger_seconds, self.name, self.keep = trigger_seconds, name, keep
        self.rows: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self.name is None or event.progress.name == self.name:
            self.rows += progress_measures(json.loads(event.progress.json), self.trigger_seconds)
            del self.rows[: -self.keep]  # the newest; write `frame` out now and then to keep all

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, MEASURE)
