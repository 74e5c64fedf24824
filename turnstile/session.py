"""Session set-up and the shared scratch folder."""

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive settings the plans rely on: joins re-plan on measured sizes and hot
# partitions are split even where that costs one more exchange downstream.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session for jobs of this package; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName("turnstile")
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, "spark.ui.enabled": "false"}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


@contextmanager
def open_writers(spark: SparkSession, files: int = 128) -> Iterator[None]:
    """Tasks that write folders by a column keep up to so many files open: they need not sort
    their rows first, nor spill them. The session's setting is put back."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(files))
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="turnstile-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder the cluster names in
    ``spark.checkpoint.dir``.

    Where none is named, a temporary folder stands in on a single machine; on a
    cluster that is an error, since executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
