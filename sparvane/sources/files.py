"""Reading and writing: JSON files with broken ones kept, tables, feeds, binaries, databases, indexing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

WORKFLOW_SCHEMA = (
    "name string, nodes array<struct<id:string,name:string,type:string,typeVersion:double,parameters:map<string,string>>>, "
    "connections string, settings string, staticData string, tags array<string>, active boolean, createdAt string, updatedAt string"
)


def read_json_files(spark: SparkSession, path: str, schema: str = WORKFLOW_SCHEMA) -> DataFrame:
    """One row per JSON file below ``path``; files that don't parse have their text in ``_corrupt_record``."""
    fields = StructType.fromDDL(schema).add(StructField("_corrupt_record", StringType()))
    reader = spark.read.schema(fields).option("multiLine", True).option("recursiveFileLookup", True).option("mode", "PERMISSIVE")
    frame = reader.option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", "*.json").json(path)
    return frame.select("*", F.col("_metadata.file_path").alias("file"))


def first_files(files: DataFrame, category: str, n: int) -> DataFrame:
    """The first ``n`` files of each category, by path."""
    return files.withColumn("_n", F.row_number().over(Window.partitionBy(category).orderBy("file"))).where(F.col("_n") <= n).drop("_n")


def count_files(spark: SparkSession, path: str, glob: str = "*.json") -> int:
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return listed.select("path").count()  # contents are not read


READERS = {"csv": {"header": "true"}, "json": {}, "text": {"wholetext": "true"}, "parquet": {}, "orc": {}, "xml": {}, "binaryFile": {}}


def extract_from_file(spark: SparkSession, path: str, kind: str, schema: str | None = None, **options: str) -> DataFrame:
    """Rows of files in any built-in format; compression is told by the file name."""
    reader = spark.read.format(kind).options(**READERS[kind] | options)
    return (reader.schema(schema) if schema else reader).load(path)


def convert_to_file(df: DataFrame, path: str, kind: str, mode: str = "errorifexists", **options: str) -> None:
    df.write.format(kind).mode(mode).options(**({"header": "true"} if kind == "csv" else {}) | options).save(path)


def write_files(rows: DataFrame, folder: str, name: str = "path", content: str = "content") -> DataFrame:
    """A file per row below ``folder`` (any file system that Arrow knows); ``(path, size)`` of those written, when it is run.

    Files are written beside and renamed, so none is ever half there, and a task that is tried again replaces its own.
    Names must be unique and stay below the folder; rows with a null name or content write nothing.
    """

    def run(batches):
        import uuid

        import pyarrow as pa
        from pyarrow.fs import FileSystem

        system, root = FileSystem.from_uri(folder)
        for batch in batches:
            done = []
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at is None or data is None:
                    continue
                if at.startswith("/") or ".." in at.split("/"):
                    raise ValueError(f"{at!r} is not below the folder")
                path = f"{root}/{at}"
                system.create_dir(path.rpartition("/")[0], recursive=True)
                beside = f"{path}.{uuid.uuid4().hex[:8]}.part"
                with system.open_output_stream(beside, compression=None) as out:
                    out.write(data)
                system.move(beside, path)
                done.append((at, len(data)))
            paths, sizes = zip(*done) if done else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "size"])

    return rows.select(F.col(name).alias("path"), F.col(content).cast("binary").alias("content")).mapInArrow(run, "path string, size long")


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Items of RSS files: title, link, description, date."""
    schema = "title string, link string, description string, pubDate string, guid string"
    return spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)


def read_sitemap(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``(loc, lastmod)`` of sitemap files, of the addresses that match ``pattern``."""
    rows = spark.read.format("xml").option("rowTag", "url").schema("loc string, lastmod string").load(path)
    return rows.where(F.col("loc").rlike(pattern)) if pattern else rows


def read_table(spark: SparkSession, url: str, query: str, partition: tuple[str, int, int, int] | None = None, **options: str) -> DataFrame:
    """A database query over JDBC; ``partition`` is (column, lower, upper, number of parallel reads)."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if not partition:
        return reader.option("query", query).load()
    column, low, high, n = partition
    bounds = {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(n)}
    return reader.option("dbtable", f"({query}) q").options(**bounds).load()


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_table(spark: SparkSession, name: str, schema: str) -> None:
    """Make an empty Parquet table unless there is one."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``fingerprint``: a digest of the given columns, nulls told apart from empty texts."""
    told = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in columns]
    return df.withColumn("fingerprint", F.sha2(F.concat_ws("\x01", *told), 256))


def index_files(files: DataFrame, indexed: DataFrame | None, force: bool = False, key: str = "filename") -> tuple[DataFrame, DataFrame]:
    """What to write, and one row of counts: ``processed, skipped, errors, total``.

    ``files`` has ``key``, ``fingerprint`` and ``error`` (null when it parsed). Files that are indexed
    with the same fingerprint are skipped, unless ``force``. Only keys and digests are joined.
    """
    good = files.where("error is null")
    if indexed is None or force:
        known = good.select(key, "fingerprint").limit(0)
    else:
        known = indexed.select(key, "fingerprint").distinct()
    fresh = good.join(known, [key, "fingerprint"], "left_anti")
    status = files.select(key, "fingerprint", "error").join(known.withColumn("_known", F.lit(True)), [key, "fingerprint"], "left")
    state = F.when(F.col("error").isNotNull(), "errors").when(F.col("_known"), "skipped").otherwise("processed")
    counts = status.agg(*[F.count_if(state == s).alias(s) for s in ("processed", "skipped", "errors")], F.count("*").alias("total"))
    return fresh, counts


def write_search_index(rows: DataFrame, path: str, rows_per_file: int = 50_000) -> None:
    """The catalog as JSON-lines files of a bounded number of rows for a browser client, written in parallel."""
    rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).json(path)
