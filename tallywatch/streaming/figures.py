"""Quality and lateness of running streams, counted in the pass that writes.

``observed`` adds counters to a stream without another read of it. Their sums come with the
progress of every batch, as does the number of rows that came behind the watermark;
``StreamFigures`` adds them up, a batch that runs again only once.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

from tallywatch.operators.quality import quality_rules

CHECKED = "checked"
QUALITY = "quality"
"""Name of the counters in a batch's progress."""


def observed(
    parsed: DataFrame, rules: dict[str, Column] | None = None, name: str = QUALITY
) -> DataFrame:
    """The same rows; what is written from them also counts rows and broken rules. Works with
    sinks that Spark writes itself; ``foreachBatch`` hands the rows to other code, and their
    counts are lost."""
    rules = rules or quality_rules()
    return parsed.observe(
        name,
        F.count("*").alias(CHECKED),
        *[F.count_if(~condition).alias(rule) for rule, condition in rules.items()],
    )


class StreamFigures(StreamingQueryListener):
    """Running totals per query; a query keeps its id when it restarts from its checkpoint.

    Register it with ``spark.streams.addListener``, or give it a query's progress by ``take``.
    Memory does not grow with the number of batches.
    """

    def __init__(self, name: str = QUALITY):
        self.name = name
        self.names: dict[str, str] = {}
        self.counts: dict[str, Counter] = {}
        self.late: Counter = Counter()
        self.rows: Counter = Counter()
        self.last_batch: dict[str, int] = {}
        self.watermarks: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.names[str(event.id)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        self.add(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def take(self, query: StreamingQuery) -> StreamFigures:
        """Add what the query still remembers of its batches and was not added yet."""
        for progress in query.recentProgress:
            self.add(progress)
        return self

    def add(self, progress: StreamingQueryProgress) -> None:
        query = str(progress.id)
        if progress.batchId <= self.last_batch.get(query, -1):
            return
        self.last_batch[query] = progress.batchId
        self.names.setdefault(query, progress.name or query)
        self.rows[query] += progress.numInputRows
        self.late[query] += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
        self.watermarks[query] = progress.eventTime.get("watermark", "")
        counters = progress.observedMetrics.get(self.name)
        if counters is not None:
            self.counts.setdefault(query, Counter()).update(counters.asDict())

    def quality_report(self, spark: SparkSession) -> DataFrame:
        """Violations per query and rule, shaped like the batch report."""
        found = [
            (self.names[query], rule, n, counts[CHECKED])
            for query, counts in self.counts.items()
            for rule, n in counts.items() if rule != CHECKED
        ]
        return spark.createDataFrame(
            found, "query string, rule string, violations long, checked long")

    def lateness_report(self, spark: SparkSession) -> DataFrame:
        """Rows read and rows dropped as late per query, and its last watermark."""
        found = [
            (self.names[q], self.rows[q], self.late[q], self.watermarks[q] or None)
            for q in self.last_batch
        ]
        return spark.createDataFrame(
            found, "query string, rows long, late_rows long, watermark string")
