"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime settings the library relies on. Adaptive execution coalesces small
# shuffle partitions and splits skewed join partitions; the zone keeps parsed
# timestamps independent of the machine.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where a later step then needs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


_FOLDERS: list[str] = []
_SHIPPED: set[str] = set()


def local_session(cores: str | int = "*", memory: str = "12g", partitions: int = 8,
                  work: str | None = None) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    if work:
        builder = builder.config("spark.checkpoint.dir", work)
    for name, value in RUNTIME_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, wherever they run.

    Functions that run in workers are found there by name. Spark serves the
    archive from the driver's own temporary folder to every executor.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    if context.applicationId in _SHIPPED or not package.is_dir():
        return
    folder = Path(tempfile.mkdtemp()).resolve()
    archive = folder / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    _SHIPPED.add(context.applicationId)


def work_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: `spark.checkpoint.dir`.

    Where a session leaves that unset, as small tests do, the work goes below
    its warehouse, which every executor of a cluster sees as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_millrace_work"
    return root.rstrip("/")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared work folder; `clear_work` deletes it again."""
    path = f"{work_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
    if not _FOLDERS:
        atexit.register(_clear_at_exit)
    _FOLDERS.append(path)
    return path


@contextmanager
def spent_shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within, each job's shuffle files go when it has ended, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a work folder, or a part of one, that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_work(spark: SparkSession) -> int:
    """Delete the folders handed out so far; frames that read them are gone with them."""
    done = 0
    while _FOLDERS:
        path = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop())
        done += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return done


def _clear_at_exit() -> None:
    """Ends a program's work folders with its session, if that still runs."""
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    with suppress(Exception):  # the JVM may be gone already
        clear_work(spark)
