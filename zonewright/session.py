"""Session helpers: the shared scratch folder and materialised intermediate tables."""

from __future__ import annotations

import atexit
import io
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from . import storage

_LOCAL_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def local_session(cores: str = "8", partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, use the cluster's own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("zonewright")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_session() -> SparkSession:
    """The session of the program's launcher: its master is what ``spark-submit`` or the defaults say. Names
    and dates are compared in UTC."""
    return SparkSession.builder.appName("zonewright").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: what the session's ``spark.checkpoint.dir`` names, or else the
    checkpoint folder that its context was given.

    Where neither is set, a local master gets a temporary folder of its own; any other master is
    refused, since a folder of one machine would not be seen by the rest.
    """
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_DIRS.get(app) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="zonewright-")
    atexit.register(shutil.rmtree, folder, True)
    spark.sparkContext.setCheckpointDir(f"file://{folder}")
    _LOCAL_DIRS[app] = f"file://{folder}"
    return _LOCAL_DIRS[app]


class Scope:
    """What is written to the shared folder within a scope goes when it ends. Scopes nest; what belongs to
    none, results that were kept among it, goes when the program ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.tables = spark, [], []

    def __enter__(self) -> Scope:
        _SCOPES.append(self)
        return self

    def __exit__(self, *_) -> None:
        _SCOPES.remove(self)
        self.clear()

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, if need be written outside this scope, so that it can be read after its end."""
        if not self.paths:
            return df
        _SCOPES.remove(self)
        try:
            return materialize(df, "result")
        finally:
            _SCOPES.append(self)

    def clear(self) -> None:
        for t in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        for p in self.paths:
            storage.delete(self.spark, p)
        self.paths, self.tables = [], []


_SCOPES: list[Scope] = []
_LAST: dict[str, Scope] = {}


def _scope(spark: SparkSession, last: bool = False) -> Scope:
    """The innermost scope, or the one that ends with the program."""
    if _SCOPES and not last:
        return _SCOPES[-1]
    app = spark.sparkContext.applicationId
    if app not in _LAST:
        _LAST[app] = Scope(spark)
    return _LAST[app]


@atexit.register
def _sweep() -> None:
    for scope in _LAST.values():
        if scope.spark.sparkContext._jsc is not None:  # a stopped context leaves its folder to whoever stopped it
            scope.clear()


def tidy(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query ``(spark, ...)`` that leaves nothing in the shared folder but its result."""

    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        with Scope(spark) as scope:
            return scope.keep(query(spark, *args))

    return run


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, which goes with the scope that it is made in."""
    path = f"{shared_dir(spark)}/zonewright/{name}-{uuid.uuid4().hex}"
    _scope(spark).paths.append(path)
    return path


def scratch_table(spark: SparkSession, name: str) -> str:
    """A new name for a table of the catalogue, which goes with the scope that it is made in."""
    table = f"zonewright_{name}_{uuid.uuid4().hex}"
    _scope(spark).tables.append(table)
    return table


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path of any file system that Hadoop knows; a missing path is no error."""
    storage.delete(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: the lineage is cut, the result
    survives the loss of executors, and later passes do not compute it again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sorted_scans(spark: SparkSession) -> None:
    """Let scans of bucketed tables say in which order their files lie, so that merge joins take sorted runs
    as they are. Spark claims an order only where each bucket is one file, as the writers here leave it."""
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")


def spread(df: DataFrame) -> DataFrame:
    """A table that was read in fewer partitions than there are cores, over all cores; larger ones stay
    as they are. For stages with much work a row on small inputs."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package through the shared folder, once an application: the nodes of a
    cluster need not have it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    target = f"{shared_dir(spark)}/zonewright/package-{uuid.uuid4().hex}.zip"
    storage.write_bytes(spark, target, packed.getvalue())
    spark.sparkContext.addPyFile(target)
    _scope(spark, last=True).paths.append(target)  # executors that join later fetch it too
    _SHIPPED.add(app)
