"""API-documentation pages in Markdown as records: one scan, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import parse_list_literal

#: What the pages say instead of an empty list; fixed values of the corpus.
NOTHING = (
    "No external integrations detected",
    "No credentials required",
    "No environment variables required",
    "Manual trigger (no automatic triggers configured)",
)


def _section(page: Column, title: str, level: int = 2) -> Column:
    """The text below a heading, up to the next heading of its level or above."""
    return F.regexp_extract(page, rf"(?s)(?:^|\n){'#' * level} {title}[^\n]*\n(.*?)(?=\n#{{1,{level}}} |\z)", 1)


def _items(section: Column) -> Column:
    items = F.regexp_extract_all(section, F.lit(r"(?m)^- `?([^`\n]*?)`?\s*$"), F.lit(1))
    return F.filter(items, lambda x: ~x.isin(*NOTHING) & (x != ""))


def _field(section: Column, name: str) -> Column:
    found = F.regexp_extract(section, rf"(?m)^- \*\*{name}\*\*:\s*`?([^`\n]*?)`?\s*$", 1)
    return F.when(found != "", found)


def parse_api_doc(page: Column) -> Column:
    """A struct of the page's fields; missing sections give empty lists and nulls."""
    about = _section(page, "Workflow Metadata")
    hooks = F.regexp_extract_all(
        _section(page, "Webhook Endpoints", 3), F.lit(r"(?s)\*\*Path\*\*: `[^`]*`\n- \*\*Method\*\*: `[^`]*`(?:\n- \*\*Webhook ID\*\*: `[^`]*`)?"), F.lit(0)
    )

    def hook(text):
        part = lambda name: F.regexp_extract(text, rf"\*\*{name}\*\*: `([^`]*)`", 1)
        return F.struct(part("Path").alias("path"), parse_list_literal(part("Method")).alias("methods"), part("Webhook ID").alias("webhook_id"))

    overview = F.trim(_section(page, "Overview"))
    return F.struct(
        F.trim(F.regexp_extract(page, r"(?m)^# (?:API Documentation: )?(.*)$", 1)).alias("title"),
        overview.alias("overview"),
        _field(about, "Total Nodes").cast("int").alias("total_nodes"),
        _field(about, "Complexity Level").alias("complexity"),
        _field(about, "Estimated Execution Time").alias("est_time"),
        F.coalesce(_field(about, "Error Handling").contains("Implemented") & ~_field(about, "Error Handling").contains("Not"), F.lit(False)).alias("error_handling"),
        _items(_section(page, "Trigger Types", 3)).alias("triggers"),
        F.transform(hooks, hook).alias("webhooks"),
        _items(_section(page, "Node Types Used")).alias("node_types"),
        _items(_section(page, "Integrations")).alias("integrations"),
        _items(_section(page, "Required Credentials")).alias("credentials"),
        _items(_section(page, "Environment Variables")).alias("env_vars"),
    )


def read_api_docs(spark: SparkSession, path: str, glob: str = "*_api_docs.md") -> DataFrame:
    """``(filename, ...)`` of every page below ``path``."""
    pages = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    return pages.select(F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("filename"), parse_api_doc(F.col("value")).alias("d")).select("filename", "d.*")
