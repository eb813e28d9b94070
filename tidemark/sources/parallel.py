"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def side_by_side(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Results of steps that each start their own jobs; the first failure is raised.

    Only the driver's waiting is threaded: the jobs share the cluster.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [step.result() for step in started]
