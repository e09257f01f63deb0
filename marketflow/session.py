"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime settings every job relies on; all can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # HotSpot leaves a method of more bytecode than this uncompiled: such a stage runs operator by operator, in small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Window state outside the heap, checkpointed by its changes.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# For checkpoints in a local folder: the manager that is Spark's default starts a process for every file status there, several a micro-batch.
# Files of such a folder have checksums already.
LOCAL_CHECKPOINT_CONF = {
    "spark.sql.streaming.checkpointFileManagerClass": "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager",
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
}

# Python workers are used again by later stages: what they free goes back to the system, both Arrow's memory and the interpreter's.
WORKER_ENV = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_TRIM_THRESHOLD_": str(1 << 20), "MALLOC_MMAP_THRESHOLD_": str(1 << 20)}


def build_session(app_name: str = "marketflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above. ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    settings = {**RUNTIME_CONF, **(LOCAL_CHECKPOINT_CONF if _keeps_files_here(spark) else {})}
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _keeps_files_here(spark: SparkSession) -> bool:
    """Whether the shared folder is one of a local file system; a folder that is yet to be made is."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        return spark.sparkContext.master.startswith("local")
    files, at = file_system(spark, root)
    return files.makeQualified(at).toUri().getScheme() == "file"


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers find the package, and hold no memory that they don't use; what the session already sets for them stays."""
    env = spark.sparkContext.environment
    root, found = str(Path(__file__).resolve().parents[1]), env.get("PYTHONPATH", "")
    if root not in found.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (root, found)))
    for key, value in WORKER_ENV.items():
        env.setdefault(key, value)


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such
    a folder would exist on one machine only, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="marketflow-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def file_system(spark: SparkSession, path: str):
    """The file system of a path, as Spark sees it, and the path in its form."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def file_state(spark: SparkSession, path: str) -> tuple:
    """Name, length and time of every file of a path: equal as long as nothing was written to it."""
    files, at = file_system(spark, path)
    found, state = files.listFiles(at, True), []
    while found.hasNext():
        status = found.next()
        state.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(state))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that a sink of this package has written; one that is gone already is no error."""
    files, at = file_system(spark, path)
    files.delete(at, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, at = file_system(spark, path)
    return files.exists(at)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced whole: written beside its place and moved there."""
    files, at = file_system(spark, path)
    _, beside = file_system(spark, f"{path}.{uuid.uuid4().hex}")
    out = files.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(at, False)
    if not files.rename(beside, at):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    return spark.read.text(path, wholetext=True).first().value


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, never used before."""
    return f"{shared_root(spark)}/marketflow/{name}-{uuid.uuid4().hex}"
