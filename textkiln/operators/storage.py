"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset a local session gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="textkiln-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


_scratch: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables made inside the block live in a folder of their own, which goes with it, also after an error: write the results before it ends."""
    folder = f"{_scratch[-1] if _scratch else shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    _scratch.append(folder)
    try:
        yield folder
    finally:
        _scratch.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_scratch[-1] if _scratch else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a shared table and read it back: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files behind tables that are written: it does so for plans that the driver's garbage collector finds unused."""
    gc.collect()
    spark._jvm.System.gc()


#: Rows of an Arrow batch of texts: the session's default of 10,000 makes batches of tens of MB in the JVM and again in the worker.
TEXT_ROWS = "1024"


def text_batches(df: DataFrame) -> DataFrame:
    """``df``; its session deals texts to workers in batches of TEXT_ROWS rows unless it was told another number."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(name) == "10000":
        df.sparkSession.conf.set(name, TEXT_ROWS)
    return df


def spread(df: DataFrame) -> DataFrame:
    """Deal a table of fewer files than cores over all cores; a table of more files is left as it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df
