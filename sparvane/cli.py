"""``python -m sparvane.cli SOURCE CATALOG [--force] [--stats]``: index a folder of JSON files, or show its figures."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import catalog
from .runtime import materialize
from .sources import files

SCHEMA = (
    "filename string, name string, active boolean, trigger_type string, complexity string, node_count int, "
    "integrations array<string>, last_indexed timestamp, fingerprint string"
)


def catalog_rows(read: DataFrame) -> DataFrame:
    """Catalog rows of files as ``read_json_files`` gives them, with ``fingerprint`` and ``error``."""
    types = F.transform("nodes", lambda n: n["type"])
    count = F.coalesce(F.when(F.size("nodes") >= 0, F.size("nodes")), F.lit(0))
    kind = F.when(F.exists(types, lambda t: F.lower(t).contains("webhook")), "Webhook")
    kind = kind.when(F.exists(types, lambda t: F.lower(t).rlike("schedule|cron|interval")), "Scheduled")
    kind = kind.when(F.exists(types, lambda t: F.lower(t).contains("trigger")), "Triggered").otherwise("Manual")
    services = F.array_sort(F.array_distinct(F.transform(types, lambda t: F.initcap(F.element_at(F.split(t, r"\."), -1)))))
    marked = files.fingerprint(read.withColumn("_nodes", F.to_json("nodes")), ["name", "_nodes", "connections", "active"])
    return marked.select(
        F.regexp_extract("file", r"([^/]+)$", 1).alias("filename"),
        F.coalesce("name", F.lit("Unnamed")).alias("name"),
        F.coalesce("active", F.lit(False)).alias("active"),
        kind.alias("trigger_type"),
        catalog.complexity(count, ("low", "medium", "high")).alias("complexity"),
        count.alias("node_count"),
        F.coalesce(F.array_compact(services), F.array().cast("array<string>")).alias("integrations"),
        F.current_timestamp().alias("last_indexed"),
        "fingerprint",
        F.when(F.col("_corrupt_record").isNotNull(), F.lit("not JSON")).alias("error"),
    )


def _current(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest row per file, or nothing if there is no catalog yet."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return None
    rows = spark.read.schema(SCHEMA).parquet(path)
    return rows.groupBy("filename").agg(F.max_by(F.struct("*"), "last_indexed").alias("r")).select("r.*")


def index(spark: SparkSession, source: str, path: str, force: bool = False) -> dict[str, int]:
    """Append what is new or changed; ``processed``, ``skipped``, ``errors`` and ``total``."""
    rows = materialize(catalog_rows(files.read_json_files(spark, source)), "catalog-rows")  # files are parsed once
    fresh, counts = files.index_files(rows, _current(spark, path), force)
    figures = counts.first().asDict()
    fresh.drop("error").write.mode("overwrite" if force else "append").parquet(path)
    return figures


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("catalog")
    parser.add_argument("--force", action="store_true", help="index every file again")
    parser.add_argument("--stats", action="store_true", help="only show the catalog's figures")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("sparvane").getOrCreate()
    if not options.stats:
        for name, n in index(spark, options.source, options.catalog, options.force).items():
            print(f"{name}: {n}")
    rows = _current(spark, options.catalog)
    if rows is None:
        print("there is no catalog yet", file=sys.stderr)
        return 1
    for name, value in catalog.catalog_stats(rows).first().asDict().items():
        print(f"{name}: {value}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
