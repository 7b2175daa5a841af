"""Session defaults and lineage cutting shared by every operator."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "landloom", cores: str = "8", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that workers can import it by name."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="landloom-src-"), "landloom.zip")
    with zipfile.ZipFile(target, "w") as z:
        for base, dirs, names in os.walk(here):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for n in names:
                full = os.path.join(base, n)
                z.write(full, os.path.join("landloom", os.path.relpath(full, here)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, read from the session.

    Only where that is unset on one machine (tests) a temporary folder takes its place; on a cluster it is an error,
    as a folder of the driver isn't there for the executors.
    """
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not known:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="landloom-")
        sc.setCheckpointDir(known)
    return known


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts lineage like a reliable checkpoint: the files outlive any executor, and are columnar and
    compressed, so they cost less disk than serialised rows.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"landloom-{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    if not _written:
        atexit.register(_at_end, spark)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._landloom_path = path
    return out


_written: list[str] = []


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard(df: DataFrame | None) -> None:
    """Delete a table made by ``materialize`` that nothing reads any more."""
    path = getattr(df, "_landloom_path", None)
    if path:
        _delete(df.sparkSession, path)
        if path in _written:
            _written.remove(path)


def _at_end(spark: SparkSession) -> None:
    try:
        release(spark)
    except Exception:  # the application is gone; what it shared went with it or is the cluster's to clean
        _written.clear()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables written inside the block when it ends; results must have been computed by then."""
    before = set(_written)
    try:
        yield
    finally:
        for path in [p for p in _written if p not in before]:
            _delete(spark, path)
            _written.remove(path)


def release(spark: SparkSession) -> None:
    """Delete every table of this driver that is left; results made from them can't be computed again."""
    while _written:
        _delete(spark, _written.pop())
