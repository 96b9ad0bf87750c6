"""Counts of what a job drops, taken in the pass that drops it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass
class Watch:
    """Collects counts under a name: on tables read them by :meth:`counts` once the job has run.

    On streams they are in each batch's progress under ``name``; see
    :func:`eventloom.streaming.sinks.dropped_counts`. One watch serves one run of one job.
    """

    name: str = "dropped"
    _seen: list[Observation] = field(default_factory=list)

    def counting(self, df: DataFrame, step: str, **conditions: Column) -> DataFrame:
        """``df`` as it is, with the number of rows that meet each condition counted as they pass."""
        counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()]
        if df.isStreaming:
            return df.observe(f"{self.name}_{step}", *counts)
        seen = Observation(f"{self.name}_{step}")
        self._seen.append(seen)
        return df.observe(seen, *counts)

    def counts(self) -> dict[str, int]:
        """All counts; waits until the job has run."""
        return {name: n for seen in self._seen for name, n in seen.get.items()}


def counting(watch: Watch | None, df: DataFrame, step: str, **conditions: Column) -> DataFrame:
    return df if watch is None else watch.counting(df, step, **conditions)
