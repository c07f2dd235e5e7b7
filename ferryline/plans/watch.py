"""A count of rejected rows that is alive while a job runs, and stops the job.

Two things end a job over its budget. A task that has seen ``budget`` rejects itself
fails, as a bulk load ends its own statement. And tasks that have ended add to a count on
the driver; when that reaches the budget, the job is cancelled by its tag, so tasks that
have not begun never run.

Spark adds a task's count once, when the task's result is taken, so retried and speculative
tasks are not counted twice in a job without a shuffle. One boolean of each row
passes through Arrow batches; all other columns stay where they are.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

POLL_SECONDS = 0.1
_OVER = "this task alone has reached the budget of rejected rows"


class BudgetReached(Exception):
    """The job was stopped; what it had counted until then is in the watch."""


class RejectWatch:
    """Counts rows and rejects of one job and stops it at ``budget`` rejects."""

    def __init__(self, spark: SparkSession, budget: int):
        self._context = spark.sparkContext
        self._budget = budget
        self._read, self._rejected = self._context.accumulator(0), self._context.accumulator(0)

    @property
    def read(self) -> int:
        """Rows in the tasks that have ended."""
        return self._read.value

    @property
    def rejected(self) -> int:
        return self._rejected.value

    def counted(self, is_reject: Column) -> Column:
        """``is_reject`` unchanged; rows count when this column is computed, so it must be used."""
        budget, read, rejected = self._budget, self._read, self._rejected
        over = _OVER

        def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = 0
            for flags in batches:
                bad = int(flags.sum())
                own += bad
                read.add(len(flags))
                rejected.add(bad)
                if own >= budget:
                    raise RuntimeError(over)
                yield flags

        return F.pandas_udf(count, "boolean")(is_reject)

    def run(self, job: Callable[[], None]) -> None:
        """Run ``job`` under a tag of its own; :class:`BudgetReached` if it was stopped."""
        tag, done, stopped = f"ferryline-{uuid.uuid4().hex}", threading.Event(), threading.Event()

        def watch() -> None:
            while not done.wait(POLL_SECONDS):
                if self.rejected >= self._budget:
                    stopped.set()
                    self._context.cancelJobsWithTag(tag)
                    return

        watcher = threading.Thread(target=watch, daemon=True)
        self._context.addJobTag(tag)
        watcher.start()
        try:
            job()
        except Exception as exc:
            # A cancelled job is an error of its own kind, which is not always a PySparkException.
            if stopped.is_set() or (isinstance(exc, PySparkException) and _OVER in str(exc)):
                raise BudgetReached from exc
            raise
        finally:
            done.set()
            watcher.join()
            self._context.removeJobTag(tag)
