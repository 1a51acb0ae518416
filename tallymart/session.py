"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

#: bytes of stored files that one task reads
SCAN_BYTES = "16m"
#: shuffled bytes that run time aims to give one task
SHUFFLE_BYTES = "16m"
_ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"

# Runtime re-planning does the sizing: joins turn into broadcasts only after
# Spark has measured the side, oversized partitions of a join or of a table
# write are split, small ones are merged.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # stored survey rows take some thirty times their bytes of Parquet when an
    # aggregate sorts them; smaller pieces are sorted without spilling
    "spark.sql.files.maxPartitionBytes": SCAN_BYTES,
    _ADVISED: SHUFFLE_BYTES,
    # the JVM runs methods above this size uncompiled; wide cleaning
    # projections are faster outside one fused stage than inside such a method
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # tables bucketed by the person key without the year, which is a partition,
    # join on both without a shuffle
    _ALL_KEYS: "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# removed when the process ends
_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def build_session(
    app_name: str = "tallymart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above; on a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = dict(SETTINGS)
    if shuffle_partitions:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    options.update(extra or {})
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: while stored tables are built: what a step has shuffled goes when the step
#: ends, as its rows are stored by then, and rows go to the files of a few years
#: as they come instead of being sorted by year first
STEP_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


@contextmanager
def storing_steps(spark: SparkSession) -> Iterator[None]:
    """``STEP_SETTINGS`` for the steps inside, the session's own ones after them.
    Each step has to run its frame once and store it."""
    before = {key: spark.conf.get(key, None) for key in STEP_SETTINGS}
    for key, value in STEP_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def small_scans(spark: SparkSession) -> None:
    """The bounds on a task's input, for sessions that were not built here; that
    on shuffled bytes only where the session names none. Tables that are stored
    in buckets join without a shuffle."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", SCAN_BYTES)
    spark.conf.set(_ALL_KEYS, "false")
    if spark.conf.get(_ADVISED, None) is None:
        spark.conf.set(_ADVISED, SHUFFLE_BYTES)


def together(spark: SparkSession, steps: Sequence[Callable[[], None]], at_once: int = 8) -> None:
    """Submit the jobs of independent steps from a few driver threads, so that
    small ones do not wait for each other; the first error is raised when all
    have ended."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(inherit(step)) for step in steps]
    for done in running:
        done.result()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    ``spark.checkpoint.dir`` is read from the session. Only a local session
    that leaves it unset gets a temporary folder, one per application.
    Anything else is an error: a machine-local folder would lose its files
    with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that all executors share"
        )
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.TemporaryDirectory(
            prefix="tallymart-", ignore_cleanup_errors=True
        )
    return _local_folders[context.applicationId].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; no two calls return the same one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
