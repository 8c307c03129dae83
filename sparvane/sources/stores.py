"""Writing to databases, and a store of values by key in the shared folder."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import compare_datasets


def write_table(df: DataFrame, url: str, name: str, mode: str = "append", **options: str) -> None:
    """Rows into a database table over JDBC, one connection per task."""
    df.write.format("jdbc").option("url", url).option("dbtable", name).options(**options).mode(mode).save()


def upsert_table(df: DataFrame, url: str, name: str, keys: list[str], **options: str) -> None:
    """Rows into an existing table: those whose ``keys`` are there replace them, others are added.

    Keys must be unique in ``df``. Tasks write a staging table beside it; one MERGE statement of the database, so
    one transaction, takes it over. A run that breaks off before has changed nothing.
    """
    staging = f"{name}_staging_{time.time_ns()}"
    write_table(df, url, staging, "overwrite", **options)
    quoted = {c: f'"{c}"' for c in df.columns}
    on = " AND ".join(f"t.{quoted[k]} = s.{quoted[k]}" for k in keys)
    values = [c for c in df.columns if c not in keys]
    update = f"WHEN MATCHED THEN UPDATE SET {', '.join(f'{quoted[c]} = s.{quoted[c]}' for c in values)} " if values else ""
    insert = f"WHEN NOT MATCHED THEN INSERT ({', '.join(quoted.values())}) VALUES ({', '.join(f's.{q}' for q in quoted.values())})"
    execute(df.sparkSession, url, f"MERGE INTO {name} t USING {staging} s ON {on} {update}{insert}", f"DROP TABLE {staging}", **options)


def execute(spark: SparkSession, url: str, *statements: str, **options: str) -> None:
    """SQL statements that give no rows, on one connection of the driver."""
    jvm = spark.sparkContext._jvm
    given = jvm.java.util.Properties()
    for k, v in options.items():
        given.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        for sql in statements:
            statement = connection.createStatement()
            statement.execute(sql)
            statement.close()
    finally:
        connection.close()


class KeyValueStore:
    """Values by key below ``path``: writes are appended, the newest counts, ``compact`` forgets the others.

    It also keeps a conversation's memory: keys are conversations, values their windows.
    """

    _SCHEMA = "key string, value string, at long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, rows: DataFrame) -> None:
        """``(key, value)`` rows; a null value deletes. Of equal keys in one call the greatest value counts."""
        rows.where("key is not null").groupBy("key").agg(F.max("value").alias("value")).withColumn("at", F.lit(time.time_ns())).write.mode("append").parquet(f"{self.path}/log")

    def _newest(self) -> DataFrame:
        try:
            log = self.spark.read.schema(self._SCHEMA).parquet(f"{self.path}/log")
        except Exception as error:  # nothing was put yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            log = self.spark.createDataFrame([], self._SCHEMA)
        return log.groupBy("key").agg(F.max(F.struct("at", "value")).alias("r")).select("key", "r.value", "r.at").where("value is not null")

    def get(self, keys: DataFrame | None = None) -> DataFrame:
        """``(key, value)`` of all keys, or of those in ``keys``."""
        rows = self._newest().select("key", "value")
        return rows if keys is None else rows.join(keys.select("key").distinct(), "key", "left_semi")

    def compact(self) -> None:
        """Writes what counts anew and drops the log; no other writer may be at work."""
        self._newest().write.mode("overwrite").parquet(f"{self.path}/new")
        fs_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = fs_path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(fs_path(f"{self.path}/log"), True)
        fs.rename(fs_path(f"{self.path}/new"), fs_path(f"{self.path}/log"))


def new_since(rows: DataFrame, column: str, store: KeyValueStore, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """The rows beyond the greatest value of ``column`` seen so far, and a function that remembers the new one.

    An incremental loop handles the rows and then calls it; if it breaks off before, the same rows come again.
    Values are kept as text and cast back, so numbers, dates, timestamps and texts will do. Null values never come.
    """
    spark, kind = rows.sparkSession, rows.schema[column].dataType.simpleString()
    last = store.get(spark.createDataFrame([(name,)], "key string")).first()
    fresh = rows.where(F.col(column).isNotNull())
    if last:
        fresh = fresh.where(F.col(column) > F.lit(last["value"]).cast(kind))

    def remember() -> None:
        newest = fresh.agg(F.max(column).cast("string").alias("value")).where("value is not null")
        store.put(newest.select(F.lit(name).alias("key"), "value"))

    return fresh, remember


class SnapshotFeed:
    """Changes of a table that tells none by itself: every poll is compared with the one before, which is kept below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        at = paths(f"{self.path}/v*/_SUCCESS")  # written last, so a poll that broke off is not there
        found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or ()
        self.version = max((int(x.getPath().getParent().getName()[1:]) for x in found), default=0)

    def poll(self, current: DataFrame, keys: list[str]) -> DataFrame:
        """``keys``, ``action`` (insert, update, delete) and the values before and after (``old_*``, ``new_*``); keys must be unique."""
        at = f"{self.path}/v{self.version + 1}"
        current.write.mode("overwrite").parquet(at)
        now = self.spark.read.schema(current.schema).parquet(at)
        before = self.spark.read.schema(current.schema).parquet(f"{self.path}/v{self.version}") if self.version else now.limit(0)
        self.version += 1
        found = compare_datasets(now, before, keys)
        action = F.when(F.col("status") == "only_a", "insert").when(F.col("status") == "only_b", "delete").when(F.col("status") == "different", "update")
        values = [c for c in current.columns if c not in keys]
        columns = [F.col(f"{side}_{c}").alias(f"{name}_{c}") for c in values for side, name in (("b", "old"), ("a", "new"))]
        return found.select(*keys, action.alias("action"), *columns).where("action is not null")
