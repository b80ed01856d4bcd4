"""Tables on shared storage whose parts are replaced together.

Every write goes to a version folder of its own, partitioned by a key.  A commit is one
small file that names the versions of every key.  Readers take the last commit, so replaced,
added and emptied keys become visible at once, and a write that fails leaves the table as
it was.  What no commit names is removed by ``vacuum``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "version"


@dataclass(frozen=True)
class Versions:
    """The table at ``path``, partitioned by the column ``key`` of ``schema``."""

    path: str
    key: str
    schema: T.StructType

    @property
    def folder(self) -> str:
        return f"{self.path.rstrip('/')}/versions"

    @property
    def commits(self) -> str:
        return f"{self.path.rstrip('/')}/commits"

    def _read_commits(self, spark: SparkSession) -> DataFrame:
        kind = self.schema[self.key].dataType.simpleString()
        return spark.read.schema(f"key {kind}, {VERSION} string, n long").parquet(self.commits)

    def committed(self, spark: SparkSession) -> tuple[int, list[tuple]]:
        """Number and (key, version) pairs of the last commit; 0 and none for a new table.

        One row per key comes to the driver, as the list of folders of a scan does.
        """
        try:
            commits = self._read_commits(spark)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return 0, []
            raise
        last = commits.agg(F.max("n")).first()[0]
        if last is None:
            return 0, []
        rows = commits.filter((F.col("n") == last) & F.col("key").isNotNull()).collect()
        return last, [(r["key"], r[VERSION]) for r in rows]

    def commit(self, spark: SparkSession, before: int, pairs: list[tuple]) -> None:
        """Make ``pairs`` what the table holds; fails if another writer came first."""
        kind = self.schema[self.key].dataType.simpleString()
        # The row without a key makes a commit of nothing a file, too.
        rows = spark.createDataFrame([(None, None), *sorted(set(pairs))], f"key {kind}, {VERSION} string")
        rows.coalesce(1).write.mode("errorifexists").parquet(f"{self.commits}/n={before + 1}")

    def write(self, rows: DataFrame) -> list[tuple]:
        """Write a new version, which no commit names yet; returns its (key, version) pairs."""
        version = uuid.uuid4().hex
        folder = f"{self.folder}/{VERSION}={version}"
        rows.write.partitionBy(self.key).parquet(folder)
        # Which keys have rows follows from the names of the folders.
        keys = rows.sparkSession.read.schema(self.schema).parquet(folder).select(self.key).distinct()
        return [(r[0], version) for r in keys.collect()]

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of the last commit; later writes do not change what is read."""
        _, pairs = self.committed(spark)
        by_version: dict[str, list] = {}
        for key, version in pairs:
            by_version.setdefault(version, []).append(key)
        if not by_version:
            return spark.createDataFrame([], self.schema)
        schema = T.StructType([*self.schema.fields, T.StructField(VERSION, T.StringType())])
        folders = [f"{self.folder}/{VERSION}={v}" for v in by_version]
        rows = spark.read.schema(schema).option("basePath", self.folder).parquet(*folders)
        # Both are partition columns: folders that the commit does not name are not scanned.
        live = [(F.col(VERSION) == v) & F.col(self.key).isin(keys) for v, keys in by_version.items()]
        return rows.filter(reduce(lambda a, b: a | b, live)).select(*self.schema.names)

    def append(self, rows: DataFrame) -> None:
        """Add rows to their keys."""
        new = self.write(rows)
        n, pairs = self.committed(rows.sparkSession)
        self.commit(rows.sparkSession, n, [*pairs, *new])

    def replace(self, rows: DataFrame, keys: list) -> None:
        """Put ``rows`` in the place of all that the keys have, all at once; a key without
        rows ends up empty."""
        new = self.write(rows.filter(F.col(self.key).isin(keys)))
        n, pairs = self.committed(rows.sparkSession)
        gone = set(keys)
        self.commit(rows.sparkSession, n, [*[p for p in pairs if p[0] not in gone], *new])

    def clear(self, spark: SparkSession, keys: list) -> None:
        n, pairs = self.committed(spark)
        self.commit(spark, n, [p for p in pairs if p[0] not in set(keys)])

    def vacuum(self, spark: SparkSession, keep: int = 1) -> list[str]:
        """Remove the versions that none of the last ``keep`` commits names; returns them.

        Not while writers are at work: what they have not committed yet would go, too.
        """
        n, _ = self.committed(spark)
        if not n:
            return []
        named = self._read_commits(spark).filter(F.col("n") > n - keep).select(VERSION).distinct()
        live = {r[0] for r in named.collect()}
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        found = [status.getPath() for status in files.listStatus(folder)] if files.exists(folder) else []
        old = [p for p in found if p.getName().startswith(f"{VERSION}=") and p.getName().split("=", 1)[1] not in live]
        for path in old:
            files.delete(path, True)
        return [p.getName().split("=", 1)[1] for p in old]
