"""What streams report about themselves, as a table."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = (
    "query string, run_id string, batch long, input_rows long, late_rows long, metrics string"
)


class ProgressTable(StreamingQueryListener):
    """Appends a row per micro-batch of every query of a session to the table at ``path``.

    ``late_rows`` counts rows behind the watermark, which state drops; ``metrics`` has the observed
    metrics as JSON. Register it with ``spark.streams.addListener``. A batch without input makes no
    row; one that runs again after a failure reports again, under its own ``run_id``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        metrics = {name: row.asDict() for name, row in p.observedMetrics.items()}
        row = (p.name, str(p.runId), p.batchId, p.numInputRows, late, json.dumps(metrics, sort_keys=True))
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
