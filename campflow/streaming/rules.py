"""The history of the row rules of running streams.

A stream counts rows and failures per rule as they pass (:func:`campflow.operators.quality.counted` under a name). The
listener takes the counts of every finished micro-batch and merges them into a table stored by day, one row per query,
batch and rule, so a report that comes twice counts once.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from campflow.operators.quality import Rule
from campflow.streaming.store import Store, Table, columns

_KEYS = ("query", "batch", "dataset", "rule")
_SCHEMA = columns(query="string", batch="bigint", dataset="string", rule="string", action="string", passed="bigint",
                  failed="bigint", dropped="bigint", at="string", day="date")
HISTORY = Table("rule_history", _SCHEMA, _KEYS, "day")


class RuleHistory(StreamingQueryListener):
    """Add it to the session (``spark.streams.addListener``) before the queries start.

    ``rules`` names the rules of each dataset, as the stream counts them. The counts of a batch are written when it has
    ended, by the thread that hands out progress reports; the queries do not wait for it.
    """

    def __init__(self, spark: SparkSession, path: str, rules: Mapping[str, Sequence[Rule]]) -> None:
        self._spark, self._path, self._rules = spark, path, dict(rules)
        self._ended: set[str] = set()
        self._news = threading.Condition()
        self.failure: Exception | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = []
        for dataset, counts in progress.observedMetrics.items():
            for rule in self._rules.get(dataset, ()):
                failed, total = counts[rule.name], counts["rows"]
                action, dropped = ("drop", failed) if rule.drops else ("warn", 0)
                rows.append((str(progress.id), progress.batchId, dataset, rule.name, action, total - failed, failed, dropped, progress.timestamp))
        if rows:
            try:
                self._write(str(progress.id), progress.batchId, rows)
            except Exception as failure:  # raised by wait(); a listener cannot fail its query
                self.failure = failure

    def _write(self, query: str, batch_id: int, rows: list[tuple]) -> None:
        counts = self._spark.createDataFrame(rows, T.StructType(_SCHEMA.fields[:-1]))
        counts = counts.withColumn("day", F.to_date(F.substring("at", 1, 10)))
        Store(self._spark, self._path).apply(query, batch_id, lambda own: own.merge(HISTORY, counts, feed=False))

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def wait(self, run_id: str, seconds: float = 120) -> None:
        """Wait until all reports of a run of a query (its ``runId``), which ends, are written."""
        with self._news:
            if not self._news.wait_for(lambda: run_id in self._ended, seconds):
                raise TimeoutError(f"no report that run {run_id} has ended")
        if self.failure:
            raise self.failure


def rule_history(spark: SparkSession, path: str) -> DataFrame:
    """One row per query, batch and rule: ``action, passed, failed, dropped``, and the time of the batch."""
    return Store(spark, path).read(HISTORY)


def rule_report(history: DataFrame) -> DataFrame:
    """The counts of all batches together, as :func:`campflow.operators.quality.quality_report` has them."""
    sums = [F.sum(c).alias(c) for c in ("passed", "failed", "dropped")]
    return history.groupBy("dataset", "rule", "action").agg(*sums)
