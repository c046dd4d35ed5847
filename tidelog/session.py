"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SQL_CONF = {
    # Days, months and cursors are UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: join strategy from measured sizes, skewed shuffle
    # partitions split, small ones merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Keyed streaming state lives on disk, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Sessions are merged inside each input partition before the shuffle, so a
    # busy source sends a few partial sessions instead of all of its rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


def builder(app: str = "tidelog") -> SparkSession.Builder:
    """A session builder with the settings above; add master and resources."""
    b = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
         # Call sites for error messages cost a round trip per column function.
         .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    for key, value in SQL_CONF.items():
        b = b.config(key, value)
    return b


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else made."""
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a fresh
    temporary folder.  On a cluster a missing setting is an error, because a
    machine-local folder would lose data with the machine.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not path and sc.getCheckpointDir():
        path = sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        path = "file:" + tempfile.mkdtemp(prefix="tidelog-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def workspace(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{home(spark)}/{name}-{uuid.uuid4().hex}"


def home(spark: SparkSession) -> str:
    """This application's own folder in the shared one."""
    return f"{shared_dir(spark)}/tidelog/{spark.sparkContext.applicationId}"


def clear_workspace(spark: SparkSession) -> None:
    """Delete everything this application staged; call it once no result of it is read any more."""
    delete(spark, home(spark))


def unstage(*staged: DataFrame) -> None:
    """Delete staged tables that nothing will read again."""
    for df in staged:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            delete(df.sparkSession, folder)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    if not path_exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return [s.getPath().getName() for s in found]


def complete_children(spark: SparkSession, path: str) -> set[str]:
    """Names of the folders in ``path`` whose write has finished."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/*/_SUCCESS")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return {s.getPath().getParent().getName() for s in found or []}


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a table that outlives any executor, and gives the
    planner exact sizes for the joins that follow.
    """
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist on whatever file system it names?"""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_complete(spark: SparkSession, path: str) -> bool:
    """True when a finished write left its success marker in ``path``."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")
