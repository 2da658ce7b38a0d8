"""Spark session settings and the shared working folder.

The library never creates a session on its own inside a report; callers pass one
in. ``build_session`` is a convenience for tests, the bench and scripts.
"""

from __future__ import annotations

import contextlib
import posixpath
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every report relies on. AQE re-plans joins at run time (broadcast after a
# small shuffle stage, skew-join splitting of hot keys, partition coalescing), and the
# session time zone is pinned so date truncation never depends on the host.
# ``requireAllClusterKeysForDistribution`` stops an aggregate on (technician, month,
# ticket) from reusing a shuffle on (technician, month) alone: that reuse would put a
# hot technician-month into one task with no map-side combine before it.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "deskmetrics",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def _machine_local(base: str, default_fs: str = "file:///") -> bool:
    """Whether a folder lies in a machine's own temporary folder: on the local file system, at or below such a folder.

    A path without a scheme is on ``default_fs``."""
    scheme = base.split(":", 1)[0] if re.match(r"[a-z0-9+.-]+:", base) else default_fs.split(":", 1)[0]
    if scheme != "file":
        return False
    path = posixpath.normpath(re.sub("^file:/+", "/", base))
    own = {"/tmp", "/var/tmp", "/dev/shm", posixpath.normpath(tempfile.gettempdir())}
    return any(path == folder or path.startswith(folder + "/") for folder in own)


def _default_fs(sc) -> str:
    return sc._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach, below ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is read as given (and handed to
    the SparkContext if only the session knows it); a cluster without it is an error,
    never a silent machine-local folder. Only in local mode without it (tests) a fresh
    folder is made and registered as the checkpoint dir.
    """
    sc = _context(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not base:
        master = sc.master if sc else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="deskmetrics-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    base = str(base).rstrip("/")
    if sc is not None and not sc.master.startswith("local") and _machine_local(base, _default_fs(sc)):
        raise RuntimeError(f"spark.checkpoint.dir = {base} is a machine-local temporary folder")
    return "/".join([base, *parts]) if parts else base


#: Folders made inside each open ``scratch``.
_OPEN: list[list[str]] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A not-yet-used path below the shared folder (one per call); it goes with the innermost open ``scratch``."""
    path = shared_dir(spark, f"{name}-{uuid.uuid4().hex}")
    if _OPEN:
        _OPEN[-1].append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Intermediate tables made inside are deleted at its end: write the result before.

    ``with scratch(spark): write_report(report(tables, period), path)``. Outside of any scope they stay, since results
    are lazy and read them; their folders are then the shared folder's own retention's."""
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.remove(made)
        for path in made:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; a client without a JVM leaves it."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder, as parquet, and continue from that copy.

    Used where one intermediate result feeds several branches that Catalyst would
    otherwise compute separately (column pruning makes their plans differ, so no
    exchange is reused). The copy is columnar and compressed, later branches read only their
    columns of it, and a lost executor re-reads the files instead of recomputing the joins
    behind them.
    """
    path = fresh_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
