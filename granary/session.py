"""Sessions, scoped settings and the scratch space of a run."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

_local_scratch: str | None = None
_made: list[str] = []


def build_session(app: str = "granary", master: str | None = None, conf: Mapping[str, object] | None = None) -> SparkSession:
    """A session with adaptive execution on and a fixed zone; ``conf`` adds to or replaces the defaults."""
    settings: dict[str, object] = {
        "spark.sql.adaptive.enabled": True,
        "spark.sql.adaptive.skewJoin.enabled": True,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": True,
    }
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def profile_session(spark: SparkSession, conf: Mapping[str, object]) -> SparkSession:
    """A sibling session (same cluster, same cache) that carries its own SQL settings.

    Frames read through it are planned and run under ``conf``; the caller's session keeps its settings, so a lazily returned
    frame needs no global switch. The caller's runtime settings are taken over first.
    """
    sibling = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and sibling.conf.isModifiable(name):
            sibling.conf.set(name, value)
    for name, value in conf.items():
        sibling.conf.set(name, str(value))
    return sibling


@contextmanager
def scoped_conf(spark: SparkSession, conf: Mapping[str, object]) -> Iterator[SparkSession]:
    """Set SQL settings for the actions inside the block and restore the former values after it."""
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, str(value))
        yield spark
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh directory name in the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of the machine: on a cluster the executors would not share it.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="granary-")
        base = _local_scratch
    _made.append(f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _made[-1]


def drop_scratch(spark: SparkSession) -> int:
    """Delete every scratch directory this program has asked for, once no lazy result needs them; returns how many there were."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    dropped = 0
    while _made:
        path = files.Path(_made.pop())
        dropped += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return dropped
