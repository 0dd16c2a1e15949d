"""Session settings the library relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Runtime settings: safe to set on a session somebody else created.
RUNTIME_CONF = {
    # Calendar keys and parsed dates must not depend on the machine's zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesces small shuffle partitions, turns a sort-merge
    # join into a broadcast join when the shuffled side proves small, and splits
    # skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming dedup keeps every key it has seen; keep that on disk, not on heap.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it.

    What the session was created with stays, but for the time zone, on which calendar keys depend.
    """
    given = spark.sparkContext.getConf()
    for key, value in RUNTIME_CONF.items():
        kept = key != "spark.sql.session.timeZone" and given.contains(key)
        if not kept and spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def side_by_side(spark: SparkSession, steps: Sequence[Callable[[], Any]], threads: int = 8) -> list[Any]:
    """Run steps that do not need each other; their results in order.

    The jobs of one step fill the cores that others leave idle.  The first error is raised when all have ended.
    """
    with ThreadPoolExecutor(threads) as pool:
        ended = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [e.result() for e in ended]


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files leave the disk when their execution ends, not when the driver happens to collect garbage.

    For steps that write what they make; a DataFrame that is executed twice shuffles twice.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def build_session(app_name: str = "marlstone", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session (tests and benchmarks); clusters bring their own."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a session on this machine alone falls back to a folder of it; on a cluster
    each executor would write to its own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder all executors reach (master is {master})")
    fallback = os.path.join(tempfile.gettempdir(), "marlstone-shared")
    os.makedirs(fallback, exist_ok=True)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/marlstone-{label}-{uuid.uuid4().hex[:12]}"
