"""Session settings the operators rely on, and shared scratch space."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from contextvars import ContextVar

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

REQUIRED = {
    # Repeated keys in one JSON object: the last one wins, as JSON readers usually do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
}
# Static: call-site capture costs more than building the large expressions used here.
AT_START = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


# Scratch folders of local sessions that name no shared one, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "geoloom", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "10g")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in {**REQUIRED, **AT_START, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def built_once(build):
    """Keep a built expression for reuse within the running Spark application.

    For functions of plain values (column names, codes) that return a Column.
    """
    kept: dict = {}

    @functools.wraps(build)
    def wrapper(*args):
        app = SparkContext._active_spark_context.applicationId
        if (app, args) not in kept:
            kept[(app, args)] = build(*args)
        return kept[(app, args)]

    wrapper.cache_clear = kept.clear
    return wrapper


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared scratch folder; a local one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="geoloom-")
    return _LOCAL_FOLDERS[app]


# Folders of the scopes that are open in this thread or task, the innermost last. A new thread has none.
_SCOPES: ContextVar[tuple[str, ...]] = ContextVar("scratch_scopes", default=())


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str, outer: bool = False) -> str:
    """A new path in the innermost open scope, or with ``outer`` in the one around it.

    Where no scope is open, what is written there goes when the application ends.
    """
    open_ = _SCOPES.get()[: -1 if outer else None]
    path = f"{open_[-1] if open_ else shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if not open_:
        at, files = _file_system(spark, path)
        files.mkdirs(at)  # only what is there can be marked
        files.deleteOnExit(at)
        files.delete(at, True)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession, name: str = "scope"):
    """Scratch tables made inside go at its end, whether it succeeds or not.

    ``with scratch_scope(spark): operator(df).write.parquet(path)`` leaves nothing behind. Scopes are held by the
    running thread: jobs and streams of other threads neither write to them nor lose tables with them. Nothing that
    is made inside may be read after the end, but for tables made with ``outer``.
    """
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    token = _SCOPES.set((*_SCOPES.get(), folder))
    try:
        yield folder
    finally:
        _SCOPES.reset(token)
        at, files = _file_system(spark, folder)
        files.delete(at, True)


def staged(operator):
    """For operators on a DataFrame, their first argument: tables they make on the way go when they return.

    What the result still reads they make with ``materialize(..., outer=True)``: it belongs to the caller's scope.
    """

    @functools.wraps(operator)
    def wrapper(df, *args, **kwargs):
        with scratch_scope(df.sparkSession, operator.__name__):
            return operator(df, *args, **kwargs)

    return wrapper


def materialize(df: DataFrame, name: str = "stage", outer: bool = False) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives every later
    branch the same rows without evaluating the input again. The table lives as long as the innermost
    open scope, with ``outer`` as the one around it.
    """
    path = scratch_path(df.sparkSession, name, outer)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
