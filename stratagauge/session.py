"""Session settings and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

# Adaptive execution does the size-dependent work: it picks broadcast joins from measured sizes,
# splits hot join partitions and resizes write partitions. `forceOptimizeSkewedJoin` lets it split
# a hot key even when a later step then needs another shuffle. The hash-join threshold applies to the
# measured partitions of the build side and saves the sort of the large side.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Marks a session that has its settings.
_TUNED = "stratagauge.tuned"


def tune(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to the session once; keep what its owner set at submission or at run time."""
    if spark.conf.get(_TUNED, None):
        return spark
    chosen = spark.sparkContext.getConf()
    for name, value in SETTINGS.items():
        set_later = name in spark.conf.getAll and spark.conf.get(name) != chosen.get(name, None)
        if not chosen.contains(name) and not set_later:
            spark.conf.set(name, value)
    spark.conf.set(_TUNED, "true")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the checkpoint folder that all executors share.

    A local session without that setting, as in tests, uses a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="stratagauge-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def side_by_side(tasks: Mapping[str, Callable[[], T]], threads: int = 4) -> dict[str, T]:
    """Run independent jobs of one session at the same time, so that the end of one write does not
    leave the cluster idle; results in the order of the tasks, the first error is raised."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=threads) as pool:
        started = {name: pool.submit(inherit(task)) for name, task in tasks.items()}
        return {name: future.result() for name, future in started.items()}
