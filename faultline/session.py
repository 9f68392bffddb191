"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Spark defaults that suit these workloads; a cluster's own settings win when
# the session already exists.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles a method above 8000 bytes; a projection with many
    # patterns in one generated method would run interpreted. Above the limit
    # Spark uses split, compilable projections instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("faultline")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used, but only for a local
    master: on a cluster a machine-local folder would lose data.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), "faultline-shared")


def new_table_path(spark: SparkSession, name: str) -> str:
    """Fresh path for a written table inside the shared folder, removed when the program ends."""
    path = f"{shared_folder(spark)}/faultline/{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(remove_scratch, spark)
    _scratch.append(path)
    return path


_scratch: list[str] = []


def remove_scratch(spark: SparkSession) -> None:
    """Delete the tables written to fresh paths so far, through Spark's file systems; local ones also without a context."""
    context = spark.sparkContext
    if getattr(context, "_jsc", None) is None:
        session = SparkSession.getActiveSession()
        context = session.sparkContext if session is not None else None
    while _scratch:
        path = _scratch.pop()
        if context is not None:
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
        elif os.path.isabs(local := path.removeprefix("file://")):
            shutil.rmtree(local, ignore_errors=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder and read back.

    Cuts the lineage, so what follows survives lost executors without repeating
    the work before it, and reads only the columns it needs.
    """
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per context, so it need not be installed on them."""
    context = spark.sparkContext
    if getattr(context, "_faultline_shipped", False):
        return
    root = Path(__file__).parent
    folder = tempfile.mkdtemp(prefix="faultline-")  # the driver serves the file from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "faultline.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    context._faultline_shipped = True
