"""Load metrics from streaming progress, and window statistics over load results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


class LoadMetrics(StreamingQueryListener):
    """Totals over all batches of all queries of a session."""

    def __init__(self):
        self.batches = self.rows = self.failed = 0
        self.durations_ms: list[int] = []

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        self.batches += 1
        self.rows += p.numInputRows
        self.durations_ms = [*self.durations_ms[-99:], int(p.batchDuration)]

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        self.failed += event.exception is not None


def observed(df: DataFrame, name: str = "scan") -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows as it runs: ``observation.get["rows"]`` afterwards."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def rollup(results: DataFrame, group: str, order: list[str], value: str, window: int = 100) -> DataFrame:
    """Running totals and a mean over the last ``window`` results of each group."""
    run = Window.partitionBy(group).orderBy(*order)
    last = run.rowsBetween(-(window - 1), Window.currentRow)
    total: Column = F.sum(value).over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return results.withColumn("total", total).withColumn("recent_mean", F.avg(value).over(last))
