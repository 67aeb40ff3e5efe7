"""Session defaults and the shared folder for scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from threading import Lock

from pyspark.sql import SparkSession


def build_session(name: str = "millrace", cores: str = "*") -> SparkSession:
    """Local session for tests and benchmarks; on a cluster the submitted session is used as it is."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )


HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"

#: Bytes of code from which the JVM does not compile a method, but interprets it.
COMPILED_BYTES = 8000

_compiled = Lock()
_inside: dict[str, tuple[int, str | None]] = {}


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Within, a stage whose code is too long for one compiled method runs as many short ones. For projections with many
    patterns; threads that share the session may be inside at the same time, the last one out restores the setting."""
    who = spark._jsparkSession.sessionUUID()
    with _compiled:
        depth, before = _inside.get(who, (0, spark.conf.get(HUGE_METHOD, None)))
        if not depth and int(before or 2**16) > COMPILED_BYTES:
            spark.conf.set(HUGE_METHOD, str(COMPILED_BYTES))
        _inside[who] = depth + 1, before
    try:
        yield
    finally:
        with _compiled:
            depth, before = _inside.pop(who)
            if depth > 1:
                _inside[who] = depth - 1, before
            elif before is None:
                spark.conf.unset(HUGE_METHOD)
            else:
                spark.conf.set(HUGE_METHOD, before)


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"millrace-{application}-")


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_root(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, never reused."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
