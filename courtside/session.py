"""Session settings and the shared scratch folder."""

import getpass
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(name: str = "courtside", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the library is tested under; a cluster's own settings stay in force."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A task lists many date folders; by default each would be a task.
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under spark.checkpoint.dir. Only a local session may lack that setting, as in tests; its
    folder is then below the system's temporary one, by user and application. Other sessions are refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{tempfile.gettempdir()}/courtside-{getpass.getuser()}/{spark.conf.get('spark.app.id', 'session')}"
    return f"{base.rstrip('/')}/courtside/{purpose}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of this library's own making, in whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: With this setting Spark deletes the shuffle files of a job at its end; without it they lie there until the driver's memory is cleaned.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs in here leave no shuffle files. Each job should be of a frame of its own: one that runs again would shuffle again."""
    before = spark.conf.get(_SHUFFLES_GO)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLES_GO, before)


def exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def subfolders(spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
    """The paths right below a folder whose names start with the prefix, in whatever store it is, in one call; none if it is absent.

    Names that start with an underscore or a dot, by which Spark marks files of its own, are left out.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{prefix}*")
    found = spark._jvm.org.apache.spark.deploy.SparkHadoopUtil.get().globPath(pattern).mkString("\n")
    return sorted(place for place in found.split("\n") if place and place.rsplit("/", 1)[-1][0] not in "_.")
