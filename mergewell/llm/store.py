"""Shared folders for tables between steps, and counts that decide how a step runs."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Arrow batches of texts have about so many bytes at most.
BATCH_BYTES = 4 << 20
_BYTES, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's bytes of an Arrow batch, unless it has set them itself.

    The default is held by each task's JVM buffer and by each of its Python workers, too much for small executors."""
    if int(str(spark.conf.get(_BYTES, str(_DEFAULT))).rstrip("b")) == _DEFAULT:
        spark.conf.set(_BYTES, str(BATCH_BYTES))


class Store:
    """A folder of tables under spark.checkpoint.dir, which driver and executors share.

    Only a local session may go without that setting; it gets a temporary folder. A written table cuts lineage, and what
    it holds outlives any executor. Results may be read from such tables until the driver ends; then the folder is deleted.
    """

    def __init__(self, spark: SparkSession, name: str):
        bounded_batches(spark)
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = spark.conf.get("mergewell.local.dir", None)
            if not base:
                base = "file://" + tempfile.mkdtemp(prefix="mergewell-")
                spark.conf.set("mergewell.local.dir", base)
        self.spark, self.root = spark, f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        atexit.register(_removed, spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write df as Parquet and read it again."""
        df.write.options(**options).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            _delete(self.spark, self.path(name))


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _removed(spark: SparkSession, root: str) -> None:
    """At the driver's end: what results were read from goes too."""
    with contextlib.suppress(Exception):  # the session's Java side may be gone
        _delete(spark, root)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
