"""Tables that outlive a lost executor: written to the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where none is set (tests, one machine) a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="addrloom-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/addrloom/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: write it as Parquet to the shared folder and read it back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._addrloom_path = path
    return table


def drop_table(table: DataFrame) -> None:
    """Delete what :func:`write_table` wrote for ``table``; nothing may read it afterwards."""
    jvm = table.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(table._addrloom_path)
    conf = table.sparkSession._jsparkSession.sessionState().newHadoopConf()
    path.getFileSystem(conf).delete(path, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df``, a table as it is read, dealt by ``key`` over all cores where it comes in fewer parts than there are cores.

    Small files and files that are read whole come as few parts, and all that is worked out of each row would stay in as
    few tasks. A table of enough parts, as large ones are, passes by without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, where they can't find it by themselves."""
    app = spark.sparkContext.applicationId
    root = Path(__file__).parent
    reach = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if app in _shipped or any(p and Path(p).resolve() == root.parent for p in reach):
        return
    target = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
