"""Session settings and working folders for the jobs of this package."""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from culvert.sources.files import remove

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Without a call site per Column a plan is stated in half the time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A JSON object with a repeated key is still JSON; the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app_name: str, **settings: str) -> SparkSession:
    """Session with the settings the jobs expect; ``settings`` are added on top."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder of the working area and read back: it is computed
    once, and its size is known to whoever plans with it."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """The folders that ``work_dir`` names in here go at the end, as those of a micro-batch
    do when all it writes is written."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in paths:
            remove(spark, path)


@contextlib.contextmanager
def lasting() -> Iterator[None]:
    """Folders named in here stay, within ``scratch`` too."""
    token = _scratch.set(None)
    try:
        yield
    finally:
        _scratch.reset(token)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path for checkpoints and intermediate tables.

    It lies under the shared folder named by ``spark.checkpoint.dir``. Only a
    local session may do without that setting; executors of a cluster cannot
    see a machine-local folder. What a local session writes goes when its
    process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (going := _scratch.get()) is not None:
        going.append(path)
    return path


@functools.cache
def _local_base() -> str:
    base = tempfile.mkdtemp(prefix="run-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base
