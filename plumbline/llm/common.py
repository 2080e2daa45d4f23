"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a run of characters other than these.
SPACE_CLASS = r"[\x20\x09-\x0D]"
_WRITTEN_BY: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or (tests only) a new local one where it is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not at:
        at = _WRITTEN_BY.get(spark.sparkContext.applicationId)
        if not at:
            at = "file://" + tempfile.mkdtemp(prefix="plumbline-")
            _WRITTEN_BY[spark.sparkContext.applicationId] = at
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/plumbline/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, survives lost executors, and is computed once."""
    at = new_path(df.sparkSession, name)
    df.write.parquet(at)
    spared(df.sparkSession)
    # Cleared tables may be empty: the schema is given, so that reading needs no file to infer it from.
    back = df.sparkSession.read.schema(df.schema).parquet(at)
    back._plumbline_path = at
    return back


def forget(df: DataFrame) -> None:
    """Deletes a table made by written() that nothing reads any more."""
    at = getattr(df, "_plumbline_path", None)
    if at:
        jvm, jsc = df.sparkSession._jvm, df.sparkSession._jsc
        path = jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)


def released(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of tables that nothing refers to any more; it does so when the JVM collects."""
    gc.collect()
    spark._jvm.System.gc()
    spared(spark)


def spared(spark: SparkSession) -> None:
    """Gives back what the driver's JVM has freed and malloc keeps for later: compiling code for plan after plan leaves hundreds of MB."""
    java, gateway = spark._jvm.java.lang, spark.sparkContext._gateway
    kinds, values = gateway.new_array(java.Class, 4), gateway.new_array(java.Object, 4)
    for k, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[k] = java.Class.forName(name)
    values[0], values[1] = spark._jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    with contextlib.suppress(Py4JError):  # not every JVM has the command
        # By the interface, since the server's own class is hidden.
        java.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(java.management.ManagementFactory.getPlatformMBeanServer(), values)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    """array<string>: the words of a text, in order."""
    return F.array_remove(F.split(text, f"{SPACE_CLASS}+"), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns only, so that reruns and retried tasks agree."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))
