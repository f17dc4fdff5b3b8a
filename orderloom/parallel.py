"""Independent jobs at once, so that the cluster is not idle while one of them ends."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")
WORKERS = 4


def together(
    spark: SparkSession, tasks: Mapping[str, Callable[[], T]], workers: int = WORKERS
) -> dict[str, T]:
    """The results of all tasks by name; the first error is raised when all have ended.

    Each runs in a thread with the caller's job properties.
    """
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        begun = {name: pool.submit(inheritable_thread_target(spark)(task)) for name, task in tasks.items()}
    return {name: future.result() for name, future in begun.items()}
