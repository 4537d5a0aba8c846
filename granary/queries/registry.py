"""The registered queries: a name, a Spark form and, where SQL can say the same, an oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


# The schema of each path of an application, together with the state of the files it was read from.
_known: dict[tuple[str, str], tuple[tuple, StructType]] = {}


def _files_state(spark: SparkSession, path: str) -> tuple:
    """Number, bytes and newest time of the files of a table, by one listing; no file is opened and no job started."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.listStatus(place)
    return len(found), sum(status.getLen() for status in found), max((status.getModificationTime() for status in found), default=0)


@dataclass(frozen=True)
class Tables:
    """The parquet tables of one data directory."""

    spark: SparkSession
    directory: str

    def __call__(self, name: str) -> DataFrame:
        path = self.path(name)
        key, state = (self.spark.sparkContext.applicationId, path), _files_state(self.spark, path)
        if key not in _known or _known[key][0] != state:
            # a read without a schema starts a job that opens file footers; it is needed again only when the files change
            _known[key] = state, self.spark.read.parquet(path).schema
        return self.spark.read.schema(_known[key][1]).parquet(path)

    def path(self, name: str) -> str:
        return f"{self.directory}/{name}.parquet"

    def through(self, spark: SparkSession) -> Tables:
        """The same tables read through another session."""
        return Tables(spark, self.directory)


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, directory: str) -> DataFrame:
        return self.build(Tables(spark, directory))


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` under its own name, with the SQL that must give the same rows."""
    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or build.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(build, sql)
        return build

    return add
