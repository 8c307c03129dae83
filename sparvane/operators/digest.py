"""Digests of records: enrich with companies and categories, count, group, render."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .search import tokens

#: Order of the sections; fixed values of the digest's layout.
CATEGORIES = ("nhsa_policy", "nhc_policy", "financial_reports", "product_launches", "bidding_tendering", "industry_media", "unknown")


def match_companies(records: DataFrame, companies: DataFrame, id_col: str, text: str) -> DataFrame:
    """``(id, company)``: companies (``company``, ``token``) whose token occurs in the text as a word.

    An equi-join on tokens, so both sides may be large; each pair comes once.
    """
    words = records.select(id_col, F.explode(F.array_distinct(tokens(F.col(text)))).alias("token"))
    return words.join(companies.select("company", F.lower("token").alias("token")), "token").select(id_col, "company").distinct()


def classify(text: Column, rules: list[tuple[str, list[str]]], otherwise: str = "unknown") -> Column:
    """The first category of which any keyword occurs in the text, letter case aside."""
    out = F.lit(otherwise)
    lowered = F.lower(text)
    for label, words in reversed(rules):
        hit = F.lit(False)
        for w in words:
            hit = hit | lowered.contains(w.lower())
        out = F.when(F.coalesce(hit, F.lit(False)), label).otherwise(out)
    return out


def priority(category: Column, order: tuple[str, ...] = CATEGORIES) -> Column:
    """The 1-based place of a category; those not listed come last."""
    place = F.array_position(F.array(*map(F.lit, order)), category)
    return F.when(place > 0, place).otherwise(len(order) + 1)


def digest_counts(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count("*").alias("total_count"), F.count_distinct("category").alias("category_count"), F.count_distinct("company").alias("company_count")
    )


def digest_groups(records: DataFrame, order: list[str], fields: list[str]) -> DataFrame:
    """``(category, company, n, records)`` with the records as an ordered list; for a digest's worth of rows."""
    grouped = records.groupBy("category", "company").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(*order, *[f for f in fields if f not in order]))).alias("records")
    )
    return grouped


def digest_map(records: DataFrame, order: list[str], fields: list[str]) -> DataFrame:
    """``(category, companies)``: category to company to list of records."""
    inner = digest_groups(records, order, fields)
    return inner.groupBy("category").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("company", "records")))).alias("companies"))


def render_text(records: DataFrame, date: str) -> DataFrame:
    """One row with the digest of a date as plain text and as HTML, sections by priority, then company."""
    rows = records.where(F.col("publish_date") == date).withColumn("_p", priority(F.col("category")))
    line = F.concat_ws(" | ", F.col("source"), F.col("publish_date"), F.col("summary"), F.col("url"))
    escaped = F.replace(F.replace(line, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    parts = rows.groupBy("_p", "category", "company").agg(F.array_sort(F.collect_list(line)).alias("lines"), F.array_sort(F.collect_list(escaped)).alias("items"))
    parts = parts.select(
        "_p", "category", "company",
        F.concat(F.lit("## "), "category", F.lit(" / "), F.coalesce("company", F.lit("-")), F.lit("\n"), F.array_join("lines", "\n")).alias("text"),
        F.concat(F.lit("<h2>"), "category", F.lit(" / "), F.coalesce("company", F.lit("-")), F.lit("</h2><ul><li>"), F.array_join("items", "</li><li>"), F.lit("</li></ul>")).alias("html"),
    )
    whole = parts.agg(F.array_sort(F.collect_list(F.struct("_p", "company", "category", "text", "html"))).alias("s"))
    join = lambda f, sep: F.array_join(F.transform("s", lambda x: x[f]), sep)
    return whole.select(F.lit(date).alias("digest_date"), join("text", "\n\n").alias("text"), join("html", "").alias("html"))


def run_summary(records: DataFrame, failures: DataFrame) -> DataFrame:
    """One row per source: its records, and why it failed, if it did (``source``, ``error``)."""
    counted = records.groupBy("source").agg(F.count("*").alias("n_records"))
    failed = failures.groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("error")), "; ").alias("errors"))
    return counted.join(failed, "source", "full_outer").select("source", F.coalesce("n_records", F.lit(0)).alias("n_records"), "errors")


def build_digest(records: DataFrame, companies: DataFrame, rules: list[tuple[str, list[str]]], date: str, id_col: str = "id", text: str = "summary") -> tuple[DataFrame, DataFrame]:
    """Both ends of the pipeline for records with ``title, summary, url, source, publish_date``: the counts, and the date's digest as text and HTML.

    A record that names several companies is listed under each, one that names none under none.
    """
    named = match_companies(records, companies, id_col, text)
    rows = records.withColumn("category", classify(F.col(text), rules)).join(named, id_col, "left")
    return digest_counts(rows), render_text(rows, date)
