"""A small table that several jobs read, change and write: versions, and a pointer that moves once.

A change writes a folder of its own and then takes the next number in ``_versions``, whose
file names the folder. A number is taken by one writer only: it is written aside and
renamed without overwriting. So readers see whole versions, and a writer whose base is no
longer the newest gets ``Conflict`` and its change has no effect. The renaming is as
atomic as the store's: it is on HDFS and on local disks by one writer a machine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer took the next version first."""


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._conf, self._Path = spark._jsc.hadoopConfiguration(), jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(self._conf)
        self._aside = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        self._rename = jvm.org.apache.hadoop.fs.Options.Rename.NONE

    def version(self) -> int:
        """The newest version's number, 0 where there is none."""
        folder = self._Path(f"{self.path}/_versions")
        if not self._fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def read(self, version: int | None = None) -> DataFrame | None:
        """A version's rows, the newest by default; None before the first."""
        n = self.version() if version is None else version
        if not n:
            return None
        stream = self._fs.open(self._Path(f"{self.path}/_versions/{n:09d}"))
        try:
            name = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return self.spark.read.parquet(f"{self.path}/{name}")

    def write(self, rows: DataFrame, base: int) -> int:
        """``rows`` as the version after ``base``, its number; ``Conflict`` if that one is there already."""
        name = f"rows-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        self._fs.mkdirs(self._Path(f"{self.path}/_versions"))
        aside = self._Path(f"{self.path}/_versions/.{name}")
        out = self._fs.create(aside, True)
        out.write(bytearray(name.encode()))
        out.close()
        try:
            self._aside.rename(aside, self._Path(f"{self.path}/_versions/{base + 1:09d}"), self._options())
        except Py4JJavaError as e:
            self._fs.delete(aside, False)
            self._fs.delete(self._Path(f"{self.path}/{name}"), True)
            if "FileAlreadyExists" in str(e.java_exception):
                raise Conflict(f"version {base + 1} of {self.path} was written by another") from e
            raise
        return base + 1

    def _options(self):
        options = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self._rename
        return options

    def update(self, change: Callable[[DataFrame | None], DataFrame], tries: int = 5) -> int:
        """``change`` of the newest version's rows as the next one; done again on what another has written meanwhile."""
        for k in range(tries):
            base = self.version()
            try:
                return self.write(change(self.read(base) if base else None), base)
            except Conflict:
                if k == tries - 1:
                    raise
        raise AssertionError
