"""Tables written to the folder all executors share.

Operators that iterate cut their lineage by writing a table here and reading it again, so that a lost
executor costs a re-read and not the whole history.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only where that is unset, a temporary one of this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return _own_folder[app]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table or folder, if it is there."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def numbered(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the finished tables in a folder that holds tables by number, in order."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return sorted(int(n) for n in names if n.isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


class Workspace:
    """A subfolder for the tables of one run of an operator.

    ``drop`` deletes a table that no later step reads. What is left, such as the tables a lazy result
    still reads, goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/millrace/{name}-{uuid.uuid4().hex}"
        atexit.register(self._clean)

    def _clean(self) -> None:
        try:
            remove(self.spark, self.path)
        except Exception:  # the session may be gone already
            pass

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as a table and return a DataFrame that reads it."""
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def together(self, names: list[str], like: DataFrame) -> DataFrame:
        """Written tables of the schema of ``like``, read by a single scan."""
        return self.spark.read.schema(like.schema).parquet(*(f"{self.path}/{n}" for n in names))

    def drop(self, name: str) -> None:
        remove(self.spark, f"{self.path}/{name}")
