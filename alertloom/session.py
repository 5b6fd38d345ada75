"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of the longest method that the JVM compiles.
HUGE_METHOD = 8000

# Scratch paths by owner, innermost last.
_owners: list[list[str]] = []


def build_session(app: str = "alertloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on and UTC timestamps; ``conf`` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # wide projections whose fused method the JVM would not compile run as separate operators
        "spark.sql.codegen.hugeMethodLimit": str(HUGE_METHOD),
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only where the cluster names none (tests, local mode) is a temporary folder
    made and used for checkpoints as well.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="alertloom-"))
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path below the shared folder, removed with its owner (``owned_scratch``) if there is one."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _owners:
        _owners[-1].append(path)
    return path


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[None]:
    """Removes on exit what was written to scratch paths inside.

    Results are lazy and read those files, so consume them before leaving.
    """
    _owners.append([])
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _owners.pop():
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


def spread(df: DataFrame, *keys: str, task_rows: int | None = None) -> DataFrame:
    """Deal rows out to all cores, by key where one is given, if the input has fewer splits than there are cores.

    A small file with one row group would otherwise be worked on by one task. An
    input with enough splits is returned as it is, without a shuffle. With
    ``task_rows``, which takes a count, there are more splits than cores if rows are many.
    """
    parts = df.sparkSession.sparkContext.defaultParallelism
    if task_rows:
        parts = max(parts, -(-df.count() // task_rows))
    return df if df.rdd.getNumPartitions() >= parts else df.repartition(parts, *keys)


def small_methods(spark: SparkSession) -> None:
    """Sets the limit of ``build_session`` for generated methods in a session that has the engine's default.

    The JVM never compiles longer methods, so that wide projections run interpreted; results are the same.
    """
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > HUGE_METHOD:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD)
