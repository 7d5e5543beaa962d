"""What streams did, from Spark's own counts: one record for each batch, and one for each query that ended."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

_SHAPE = "run string, parent string, status string, error string, rows_read long, seconds double"


class BatchRecords(StreamingQueryListener):
    """Keeps a record of each batch of the queries that run while it is attached: `with BatchRecords(spark) as records`. Events come a little later than the batches; wait_for() waits."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.batches, self.ended = spark, {}, {}
        self._news = threading.Condition()

    def __enter__(self) -> BatchRecords:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        with self._news:
            self.batches.setdefault(str(event.runId), {})

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        with self._news:
            # a batch is told of again when nothing new comes
            if p.numInputRows or p.batchId not in self.batches.setdefault(str(p.runId), {}):
                self.batches[str(p.runId)][p.batchId] = (p.numInputRows, (p.durationMs or {}).get("triggerExecution", 0) / 1000)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._news:
            said = event.errorClassOnException or (event.exception and "StreamingQueryException")
            self.ended[str(event.runId)] = said or None
            self._news.notify_all()

    def wait_for(self, *queries, seconds: float = 30) -> bool:
        """Whether the ends of the queries have been told of within the time."""
        wanted = {str(q.runId) for q in queries}
        with self._news:
            return self._news.wait_for(lambda: wanted <= set(self.ended), seconds)

    def runs(self, names: dict[str, str] | None = None) -> DataFrame:
        """run, parent, status, error, rows_read, seconds: a row for each batch under its query, and one for each query with the sums. names: run id -> name. Errors are told
        by their class, never by their text."""
        rows = []
        with self._news:
            for run, batches in self.batches.items():
                name, error = (names or {}).get(run, run), self.ended.get(run)
                status = "running" if run not in self.ended else "failed" if error else "success"
                rows.append((name, None, status, error, sum(n for n, _ in batches.values()), float(sum(s for _, s in batches.values()))))
                rows += [(f"{name}/{number}", name, "success", None, n, float(s)) for number, (n, s) in sorted(batches.items())]
        return self.spark.createDataFrame(rows, _SHAPE)


def totals(runs: DataFrame) -> DataFrame:
    """runs, failed, rows_read, seconds over the queries; batches aren't counted twice."""
    return runs.where(F.col("parent").isNull()).agg(F.count("*").alias("runs"), F.count_if(F.col("status") == "failed").alias("failed"), F.coalesce(F.sum("rows_read"), F.lit(0)).alias("rows_read"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"))
