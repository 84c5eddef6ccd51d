"""Registration helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from turnstile.session import stage
from turnstile.sources import star

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


# Tables written once per session and state of a data folder.
_stored: dict[tuple, DataFrame] = {}


def folder_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of a folder's tables; a stored table is of use only for these."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/*.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)

# Entities whose mapping needs joins or aggregates. Like flat tables of a real run they are
# written once and then read by every query.
STORED_ENTITIES = ("t_guest", "t_ticket", "t_order", "t_summary")


class Lake:
    """Entities and base tables of one data folder, each read once per query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = star.table(self.spark, self.sf_dir, name)
        return self._tables[name]

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A derived table, written on first use."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name,
               folder_state(self.spark, self.sf_dir))
        if key not in _stored:
            _stored[key] = stage(build(), name)
        return _stored[key]

    def once(self, name: str) -> DataFrame:
        """An entity for a query that reads it once: its plan, so that Spark leaves out columns and
        rows the query does not need, unless it is stored already."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name,
               folder_state(self.spark, self.sf_dir))
        return _stored.get(key) or star.run_entity(self.spark, name, self.table)

    def __getattr__(self, name: str) -> DataFrame:
        if name in STORED_ENTITIES:
            return self.stored(name, lambda: star.run_entity(self.spark, name, self.table))
        if name.startswith("t_"):
            return star.run_entity(self.spark, name, self.table)
        if name in star.TABLES:
            return self.table(name)
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        return star.run_sql(self.spark, text, self.table)


def query(name: str, sql: str | None = None, entities: str = "") -> Callable:
    """Register ``fn(lake)`` under a name, with SQL over the named entities if given."""

    def wrap(fn: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: fn(Lake(spark, sf_dir))
        if sql is not None:
            head = star.with_entities(*entities.split()) if entities else ""
            body = sql.strip()
            if head and body.startswith(","):
                if "FROM dp" in body:
                    head = head.replace("WITH ", "WITH RECURSIVE ", 1)
                ORACLES[name] = head + body
            else:
                ORACLES[name] = f"{head}\n{body}" if head else body
        return fn

    return wrap
