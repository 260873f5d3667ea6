"""Session settings the operators read."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A window or grouped function may put up to this many rows of one key in one
# task. Larger keys take the split path in ``operators.ordered``.
GROUP_ROWS_KEY = "spark.millrace.maxGroupRows"
GROUP_ROWS_DEFAULT = 2_000_000


def local_session(cores: str = "8", app: str = "millrace") -> SparkSession:
    """A local session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "20g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def max_group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(GROUP_ROWS_KEY, str(GROUP_ROWS_DEFAULT)))


def stage_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Only a session within one process (master ``local`` or ``local[...]``) without that
    setting gets a folder of its own, which goes when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="millrace-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


_STAGED: list[str] = []


def staged() -> list[str]:
    """Folders of the tables that this process has staged and not dropped, oldest first."""
    return list(_STAGED)


def drop_staged(spark: SparkSession, folders: list[str] | None = None) -> int:
    """Delete staged tables, all of this process or the given ones; returns how many went.

    For tables whose readers have been written, or staged, themselves.
    """
    files = spark._jvm.org.apache.hadoop.fs
    gone = 0
    for folder in list(_STAGED) if folders is None else [f for f in folders if f in _STAGED]:
        path = files.Path(folder)
        gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _STAGED.remove(folder)
    return gone


def folders_of(*tables: DataFrame) -> list[str]:
    """Those of the staged folders that the given tables read."""
    read = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for t in tables for f in t.inputFiles()}
    return [f for f in _STAGED if f.rsplit("/", 1)[-1] in read]


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and fixes row placement, and survives lost executors
    because the rows live in files rather than in executor storage. The folder
    may be emptied once the results that were built on it are written.
    """
    spark = df.sparkSession
    path = f"{stage_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    _STAGED.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
