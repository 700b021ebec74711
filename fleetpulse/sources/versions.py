"""Small tables replaced as a whole: versions side by side, and a numbered log that says which holds."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Versions that stay for readers that began with them.
KEPT = 3


class ConcurrentWriter(RuntimeError):
    """Another writer has replaced the version that a change was made from."""


@dataclass(frozen=True)
class VersionedTable:
    """A table at ``path`` that readers see before or after a replacement, never between.

    A version is written to a folder of its own. Then a file with the folder's
    name is renamed to the next number of the log, which fails if that number
    is taken. A writer that stops before leaves the old version as it is.
    """

    path: str
    schema: T.StructType

    @property
    def _log(self) -> str:
        return f"{self.path.rstrip('/')}/_versions"

    def _numbers(self, spark: SparkSession) -> list[int]:
        hadoop = spark._jvm.org.apache.hadoop.fs
        log = hadoop.Path(self._log)
        files = log.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(log):
            return []
        names = [entry.getPath().getName() for entry in files.listStatus(log)]
        return sorted(int(n) for n in names if n.isdigit())

    def _folder(self, spark: SparkSession, number: int) -> str:
        jvm = spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self._log}/{number:08d}")
        stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
        try:
            return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def version(self, spark: SparkSession) -> int:
        """Number of the present version, 0 before the first."""
        return max(self._numbers(spark), default=0)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The rows of a version, the present one by default."""
        number = self.version(spark) if version is None else version
        if not number:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path.rstrip('/')}/{self._folder(spark, number)}")

    def replace(self, rows: DataFrame, based_on: int) -> int:
        """Make ``rows``, worked out from version ``based_on``, the present version; returns its number."""
        spark = rows.sparkSession
        folder = f"v-{uuid.uuid4().hex}"
        rows.select(*self.schema.fieldNames()).write.parquet(f"{self.path.rstrip('/')}/{folder}")
        number = based_on + 1
        if self.version(spark) != based_on:
            raise ConcurrentWriter(f"{self.path} has moved on from version {based_on}")
        self._enter(spark, number, folder)
        self._clean(spark)
        return number

    def _enter(self, spark: SparkSession, number: int, folder: str) -> None:
        jvm = spark._jvm
        hadoop, conf = jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        staged, final = hadoop.Path(f"{self._log}/.{folder}"), hadoop.Path(f"{self._log}/{number:08d}")
        stream = staged.getFileSystem(conf).create(staged, False)
        stream.write(bytearray(folder.encode()))
        stream.close()
        context = hadoop.FileContext.getFileContext(staged.getFileSystem(conf).getUri(), conf)
        try:
            # Without the option to overwrite, the rename fails where the number is taken.
            context.rename(staged, final, spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
        except Py4JJavaError as failed:
            if "FileAlreadyExists" not in str(failed.java_exception):
                raise
            raise ConcurrentWriter(f"{self.path} has a version {number} already") from failed

    def _clean(self, spark: SparkSession) -> None:
        hadoop = spark._jvm.org.apache.hadoop.fs
        for number in self._numbers(spark)[:-KEPT]:
            folder = self._folder(spark, number)
            for name in (f"{self._log}/{number:08d}", f"{self.path.rstrip('/')}/{folder}"):
                at = hadoop.Path(name)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
