"""Independent Spark jobs at the same time, each in a scheduler pool of its own.

With ``spark.scheduler.mode=FAIR`` the pools share the cluster's slots, so a
short table doesn't wait for a long one; with the default mode the jobs still
overlap where slots are free.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

R = TypeVar("R")
POOL = "spark.scheduler.pool"


def run_all(spark: SparkSession, jobs: Sequence[tuple[str, Callable[[], R]]], workers: int = 1) -> list[R | Exception]:
    """The result of every ``(name, job)``, or the exception that ended it, in
    order. At most ``workers`` run at once, each in a pool ``name``; one that
    fails does not stop the others."""
    context = spark.sparkContext

    def outcome(name: str, job: Callable[[], R], pool: bool) -> R | Exception:
        if pool:
            context.setLocalProperty(POOL, name)
        try:
            return job()
        except Exception as ex:  # noqa: BLE001 - it is the job's outcome
            return ex
        finally:
            if pool:
                context.setLocalProperty(POOL, None)

    if workers <= 1 or len(jobs) <= 1:
        return [outcome(name, job, False) for name, job in jobs]
    with ThreadPoolExecutor(workers) as threads:
        return list(threads.map(lambda j: inheritable_thread_target(spark)(outcome)(*j, True), jobs))
