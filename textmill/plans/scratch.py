"""Written tables that cut lineage: they survive the loss of executors, and every later pass sees the same rows."""

from __future__ import annotations

import atexit
import re
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

#: Bytes of a row group of a written table: a writer holds one for each task, and a reader each of its columns at once.
ROW_GROUP = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or what the context was given.

    A local folder stands in only where neither is set and the master is local; elsewhere that is an error.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        import tempfile

        found = f"file://{tempfile.gettempdir()}/textmill-checkpoints"
        context.setCheckpointDir(found)
    return re.sub(r"^file:/+", "file:///", found).rstrip("/")


class Scratch:
    """Tables below the shared folder. They are deleted when the application ends, by `close`, or where a `with` ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/textmill-{uuid.uuid4().hex}"
        self.names: set[str] = set()
        atexit.register(self.drop)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        self.close()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        """df, written as Parquet and read again. codec: zstd where whole texts are written; hashes hardly shrink, and its
        compressors take memory outside the heap."""
        df.write.mode("overwrite").option("compression", codec).option("parquet.block.size", ROW_GROUP).parquet(self.path(name))
        self.names.add(name)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def keep(self, *names: str) -> None:
        """Delete all tables but these."""
        for name in self.names.difference(names):
            self.drop(name)

    def drop(self, name: str = "") -> None:
        """Delete one table, or all of them; after the session has ended through Arrow's file systems."""
        address, context = self.path(name) if name else self.root, self.spark.sparkContext
        if context._jsc is not None:
            path = context._jvm.org.apache.hadoop.fs.Path(address)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
            return
        system, path = fs.FileSystem.from_uri(address)
        if system.get_file_info(path).type != fs.FileType.NotFound:
            system.delete_dir(path)

    def close(self) -> None:
        """Delete all tables now instead of at the end of the application; their DataFrames cannot be read any more."""
        self.drop()
        atexit.unregister(self.drop)
