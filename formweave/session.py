"""Session helpers: a tuned local session for tests and bench, and the
shared work folder used to cut lineage or stage intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession



class NoSharedFolderError(RuntimeError):
    """A session that is not local names no shared folder."""


# Settings every session of ours wants.  On a cluster the launcher sets
# executor memory, shuffle partitions and the checkpoint folder; these
# only fill gaps.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "formweave",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults applied.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - no SparkContext on a Connect session
        pass
    ensure_checkpoint_dir(spark)
    return spark


# HotSpot never compiles a longer method (bytes of code): it interprets it.
HUGE_METHOD = 8000


def compile_wide_plans(spark: SparkSession) -> None:
    """Let Spark compile plans over very many columns in small methods.

    A plan over a hundred columns becomes one generated method that the JVM only
    interprets.  With this setting such a plan is compiled expression by
    expression.  Spark's own default leaves it to the user; a value that was set
    lower stays.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name, "65535")) > HUGE_METHOD:
        spark.conf.set(name, str(HUGE_METHOD))


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes begun inside delete their shuffle files when they end.

    Spark itself keeps them until the driver's garbage collector finds the plan,
    which may be long after.  Only for frames that are written once.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir`` (a folder every executor
    can reach).  Only a local session without one gets a folder of its own,
    as in tests; elsewhere a missing setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: only the conf is visible
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise NoSharedFolderError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="formweave-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # noqa: BLE001 - static conf on some sessions
            pass
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def work_dir(spark: SparkSession, name: str = "work") -> str:
    """The path of a fresh folder below the shared checkpoint folder (Spark's
    writers create it)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`work_dir`, through the file system it is on."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
